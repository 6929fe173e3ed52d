"""How far the sources of a language differ in their use of terms.

Terms are counted inside tasks, by length: terms of up to 8 and up to 16 bytes are one or two unsigned
64-bit words, which are radix-sorted and counted as runs; longer terms are sorted as bytes, those of each
length for themselves. Counts of all tasks are then ordinary aggregations.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.common import saved, small_batches
from ledgerwatch.operators.skew import short

WORD_BYTES = 8
#: Bytes of text that are taken apart at a time, more if one text has more; such a text is cut, between two terms.
BLOCK_BYTES = 12 << 20
COUNTED = "lang string, source string, term string, n bigint, docs bigint"

#: What a byte of a text becomes: itself in a term, lower case for A-Z, 0 between terms.
BYTES = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 0 for b in range(256)], np.uint8)


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """The stable order of rows by their ``words``, the first of which weighs most.

    Sixteen bits at a time from the last ones on; numpy sorts these by counting. Digits that
    are equal in all rows are left out.
    """
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in (0, 16, 32, 48):
            digit = ((word >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def packed(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, word: int) -> np.ndarray:
    """Bytes ``8 * word`` to ``8 * word + 7`` of each term as a number that sorts like them; zeros behind its end."""
    out = np.zeros(len(starts), np.uint64)
    for k in range(word * WORD_BYTES, (word + 1) * WORD_BYTES):
        byte = np.where(k < lengths, data[np.minimum(starts + k, len(data) - 1)], 0)
        out = (out << np.uint64(8)) | byte.astype(np.uint64)
    return out


def counted_runs(
    words: list[np.ndarray], group: np.ndarray, doc: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position of one row of each run of equal ``words`` in a group, the run's rows, and its documents.

    Rows come in order of group and document, and stay so within a term.
    """
    order = radix_order(words)
    changed = np.ones(len(order), bool)
    changed[1:] = group[order][1:] != group[order][:-1]
    for word in words:
        changed[1:] |= word[order][1:] != word[order][:-1]
    first = np.flatnonzero(changed)
    changed[1:] |= doc[order][1:] != doc[order][:-1]
    n = np.diff(np.append(first, len(order)))
    return order[first], n, np.add.reduceat(changed.astype(np.int64), first)


def term_counts(data: np.ndarray, begins: np.ndarray, groups: np.ndarray) -> Iterator[tuple]:
    """``(group, term, n, docs)`` as arrays, for the terms in ``data`` (bytes as ``BYTES`` gives them).

    ``begins`` tells where each document begins; a zero parts documents. ``groups`` are theirs, ascending.
    """
    inside = np.concatenate([[False], data != 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    doc = (np.searchsorted(begins, starts, side="right") - 1).astype(np.int32)
    group = groups[doc]
    for n_words in (1, 2):
        chosen = (lengths <= n_words * WORD_BYTES) & (lengths > (n_words - 1) * WORD_BYTES)
        at, size = starts[chosen], lengths[chosen]
        if len(at):
            words = [packed(data, at, size, k) for k in range(n_words)]
            row, n, docs = counted_runs(words, group[chosen], doc[chosen])
            text = np.stack([w[row] for w in words], axis=1).astype(">u8").view(f"S{n_words * WORD_BYTES}").ravel()
            yield group[chosen][row], text, n, docs
    for size in np.unique(lengths[lengths > 2 * WORD_BYTES]):
        chosen = lengths == size
        text = data[starts[chosen][:, None] + np.arange(size)].view(f"S{size}").ravel()
        # Sorted as bytes, every term has its number, which is counted like a word.
        terms, number = np.unique(text, return_inverse=True)
        row, n, docs = counted_runs([number.astype(np.uint64)], group[chosen], doc[chosen])
        yield group[chosen][row], text[row], n, docs


def long_text_counts(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The terms of one long text and how often they occur; it is cut between terms."""
    found: Counter[bytes] = Counter()
    data, start = BYTES[np.frombuffer(text, np.uint8)], 0
    gaps = np.flatnonzero(data == 0)
    while start < len(data):
        k = np.searchsorted(gaps, start + BLOCK_BYTES)
        end = int(gaps[k]) + 1 if k < len(gaps) else len(data)
        part = data[start:end]
        for _, terms, n, _ in term_counts(part, np.zeros(1, np.int64), np.zeros(1, np.int32)):
            for term, count in zip(terms.tolist(), n.tolist(), strict=True):
                found[term] += count
        start = end
    return np.array(list(found), object), np.array(list(found.values()), np.int64)


def block_counts(rows: list[tuple[str, str, bytes]]) -> Iterator[pa.RecordBatch]:
    """The counts of some documents, ``(lang, source, text)`` each."""
    rows.sort(key=lambda row: row[:2])
    keys = [row[:2] for row in rows]
    names = sorted(set(keys))
    number = {key: k for k, key in enumerate(names)}
    groups = np.array([number[key] for key in keys], np.int32)
    sizes = np.array([len(row[2]) + 1 for row in rows])
    data = BYTES[np.frombuffer(b"\0".join([*[row[2] for row in rows], b""]), np.uint8)]
    yield from batches_of(names, term_counts(data, np.cumsum(sizes) - sizes, groups))


def batches_of(names: list[tuple[str, str]], parts: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    langs, sources = (pa.array([name[k] for name in names], pa.string()) for k in (0, 1))
    for group, terms, n, docs in parts:
        text = pa.array(terms.tolist(), pa.binary()).cast(pa.string())
        columns = [langs.take(pa.array(group)), sources.take(pa.array(group)), text, pa.array(n), pa.array(docs)]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Term counts per language and source of batches of ``(lang, source, text)``, block by block."""
    held, size = [], 0
    for batch in batches:
        for lang, source, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            text = text.encode()
            if len(text) > BLOCK_BYTES:
                terms, n = long_text_counts(text)
                yield from batches_of([(lang, source)], iter([(np.zeros(len(n), np.int32), terms, n, np.ones(len(n), np.int64))]))
                continue
            held.append((lang, source, text))
            size += len(text) + 1
            if size > BLOCK_BYTES:
                yield from block_counts(held)
                held, size = [], 0
    if held:
        yield from block_counts(held)


# Sources that meet in one tile of pairs, and the cells of a block of terms by sources.
TILE = 256
CELLS = 1 << 18
SUMS = "lang string, low int, high int, sums array<bigint>"
#: Sums of pairs that a task keeps before it hands them on.
KEPT_CELLS = 1 << 22


def difference(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """``floor((p - q)^2 / (p + q))`` of whole numbers up to 2^31."""
    return (p - q) ** 2 // (p + q)


def pair_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums of differences over terms, for all pairs of a source of tile ``low`` with one of tile ``high``.

    A row is a term of a language: ``at_low`` and ``at_high`` are the places of sources with that term in their
    tiles, ``p_low`` and ``p_high`` their figures, and ``none_low`` and ``none_high`` those of sources without it.
    """
    kept: dict[tuple, np.ndarray] = {}

    def flushed() -> Iterator[pd.DataFrame]:
        if kept:
            keys = list(kept)
            yield pd.DataFrame(
                {
                    "lang": [k[0] for k in keys],
                    "low": np.array([k[1] for k in keys], np.int32),
                    "high": np.array([k[2] for k in keys], np.int32),
                    "sums": [kept[k].ravel() for k in keys],
                }
            )
        kept.clear()

    def table(rows: pd.DataFrame, side: str) -> np.ndarray:
        none = np.asarray(rows[f"none_{side}"].iloc[0], np.int64)
        out = np.repeat(none[None, :], len(rows), axis=0)
        at = rows[f"at_{side}"].to_list()
        row = np.repeat(np.arange(len(rows)), [len(a) for a in at])
        out[row, np.concatenate(at)] = np.concatenate(rows[f"p_{side}"].to_list())
        return out

    for batch in batches:
        for key, rows in batch.groupby(["lang", "low", "high"], sort=False):
            wide = len(rows["none_low"].iloc[0]) + len(rows["none_high"].iloc[0])
            step = max(1, CELLS // wide)
            for k in range(0, len(rows), step):
                low, high = table(rows[k : k + step], "low"), table(rows[k : k + step], "high")
                sums = np.stack([difference(high, low[:, [i]]).sum(axis=0) for i in range(low.shape[1])])
                kept[key] = kept[key] + sums if key in kept else sums
            if sum(s.size for s in kept.values()) > KEPT_CELLS:
                yield from flushed()
    yield from flushed()


#: One row of a language and source, or of a tile of sources, is broadcast up to this many of them.
MOST_GROUPS = 50_000
MOST_TILES = 2_000
SCALE = 1_000_000_000


def figure(n: str, total: str, kept: str) -> str:
    """SQL for a term's smoothed share of ``total`` in parts of ``SCALE``, plus one; exact for any counts."""
    part = f"cast({SCALE} as decimal(10,0)) * cast({n} + 2 as decimal(20,0))"
    return f"cast(1 + ({part}) div cast({total} + 2 * {kept} as decimal(20,0)) as bigint)"


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10, text: str = "text") -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how each source of a language differs from the others.

    Terms are runs of letters A-Z in either case and characters beyond ASCII; a language keeps those in at least
    ``min_docs`` of its documents. Every (lang, source) gives each kept term of the language a figure from its
    count, zero too. Part ``pair`` has all other sources of the language by the sum of differences over all kept
    terms, part ``term`` the ``top`` terms that a source uses more than its language does. Equal values go by
    the bytes of the item. Null texts, languages and sources count as empty ones; a source without terms is
    compared like any other; a language without kept terms has differences of zero. Repeated rows are documents
    of their own. An empty table gives no rows. Further columns are not read.
    """
    read = docs.selectExpr(*[f"coalesce(`{c}`, '') as {name}" for c, name in (("lang",) * 2, ("source",) * 2, (text, "text"))])
    counted = small_batches(read).mapInArrow(count_terms, COUNTED)
    counts = saved(counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    of_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = of_lang.where(f"docs >= {min_docs}").drop("docs")
    used = saved(counts.drop("docs").join(kept, ["lang", "term"]))
    groups = saved(_groups(read.select("lang", "source").distinct(), used))
    known = short(groups.where("kept > 0"), MOST_GROUPS)
    terms = used.join(known, ["lang", "source"]).selectExpr(
        "lang", "source", "place", "term", f"{figure('n', 'total', 'kept')} as p", f"{figure('lang_n', 'lang_total', 'kept')} as q"
    )
    more = terms.where("p > q").selectExpr("lang", "source", "'term' as part", "term as item", "(p - q) * (p - q) div (p + q) as value")
    return _ranked(more).where(f"rank <= {top}").unionByName(_ranked(_pairs(terms, groups)))


def _groups(groups: DataFrame, used: DataFrame) -> DataFrame:
    """``(lang, source)`` with the numbers of kept terms and their occurrences, and the source's place in its language."""
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = used.select("lang", "term", "lang_n").distinct().groupBy("lang")
    langs = langs.agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    return groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").selectExpr(
        "lang", "source", "coalesce(total, 0L) as total", "coalesce(kept, 0L) as kept", "coalesce(lang_total, 0L) as lang_total",
        "row_number() over (partition by lang order by source) - 1 as place",
    )


def _pairs(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """The sums of differences of all pairs of sources of a language, in both directions."""
    # What a source without the term gives it. Without any kept term nothing differs.
    none = f"if(kept > 0, {figure('0L', 'total', 'greatest(kept, 1L)')}, 1L)"
    tiles = groups.selectExpr("lang", f"place div {TILE} as tile", f"struct(place, {none} as p) as one").groupBy("lang", "tile")
    tiles = saved(tiles.agg(F.expr("transform(array_sort(collect_list(one)), one -> one.p) as none")))
    n_tiles = short(tiles.groupBy("lang").agg(F.expr("cast(count(*) as int) as tiles")), MOST_GROUPS)
    found = terms.groupBy("lang", "term").agg(F.expr("collect_list(struct(place, p)) as found")).drop("term")
    empty = "cast(array() as array<struct<place:int,p:bigint>>) as found"
    found = found.unionByName(groups.where("kept = 0 and place = 0").selectExpr("lang", empty))
    spread = found.join(n_tiles, "lang").selectExpr("lang", "found", "explode(sequence(0, tiles - 1)) as low", "tiles")
    spread = spread.selectExpr("lang", "found", "low", "explode(sequence(low, tiles - 1)) as high")
    for side in ("low", "high"):
        of_side = tiles.selectExpr("lang", f"cast(tile as int) as {side}", f"none as none_{side}")
        spread = spread.join(short(of_side, MOST_TILES), ["lang", side])
    sides = []
    for side in ("low", "high"):
        own = f"filter(found, one -> one.place div {TILE} = {side})"
        sides += [f"transform({own}, one -> one.place % {TILE}) as at_{side}", f"transform({own}, one -> one.p) as p_{side}"]
    sums = spread.selectExpr("lang", "low", "high", "none_low", "none_high", *sides).mapInPandas(pair_sums, SUMS)
    cells = sums.selectExpr("lang", "low", "high", "posexplode(sums) as (cell, value)").groupBy("lang", "low", "high", "cell")
    widths = short(tiles.selectExpr("lang", "cast(tile as int) as high", "size(none) as width"), MOST_GROUPS)
    pairs = cells.agg(F.sum("value").alias("value")).join(widths, ["lang", "high"]).selectExpr(
        "lang", "value", f"cast(low * {TILE} + cell div width as int) as a", f"cast(high * {TILE} + cell % width as int) as b", "low = high as whole"
    )
    both = pairs.where("a <> b").selectExpr("lang", "value", "inline(if(whole, array(struct(a as own, b as other)), array(struct(a as own, b as other), struct(b as own, a as other))))")
    for end, name in (("own", "source"), ("other", "item")):
        names = short(groups.selectExpr("lang", f"place as {end}", f"source as {name}"), MOST_GROUPS)
        both = both.join(names, ["lang", end])
    return both.selectExpr("lang", "source", "'pair' as part", "item", "value")


def _ranked(rows: DataFrame) -> DataFrame:
    order = "partition by lang, source order by value desc, item"
    return rows.selectExpr("*", f"row_number() over ({order}) as rank")

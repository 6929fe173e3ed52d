"""Byte-pair encoding in linear time, and decoding.

A text is cut into pieces, and no merge crosses a piece. Within a piece the merges that pairwise merging
would make are found from left to right: at a position the longest token that an Aho-Corasick automaton
finds there is tried first, then the shorter tokens it begins with. A token may stand behind another one if
merging the two's bytes alone would give these two. If none fits, the last token is taken back, and the
position it led to is not tried again. What comes out is the same as merging in order of rank.
"""

from __future__ import annotations

import codecs
import gc
import hashlib
import json
import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, islice

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.common import small_batches

# Fixed value: how a byte-level vocabulary without a pattern of its own cuts texts into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same for texts of ASCII characters only.
ASCII_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
#: Pieces up to this many characters are remembered, at most twice this many; all others are encoded each time.
KEPT_CHARS, KEPT_PIECES = 64, 1 << 20
#: So many pairs of tokens are remembered as fitting or not.
KEPT_PAIRS = 1 << 20
#: Pieces whose tokens are put together at a time.
PART_PIECES = 1 << 16
#: Texts up to this many characters are cut into pieces at once.
PART_CHARS = 1 << 20
TOKENS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: visible Latin-1 characters stand for
    themselves, the others for the characters from 256 on.
    """
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(others)}


@dataclass(frozen=True)
class Vocabulary:
    """A byte-level vocabulary: the bytes of each token id, its merges in order, and its special texts.

    ``merges`` are pairs of ids with the id they become.
    """

    tokens: dict[int, bytes]
    merges: list[tuple[int, int, int]]
    special: dict[str, int]

    @staticmethod
    def read(file: bytes) -> Vocabulary:
        """From the content of a tokenizer file (JSON) with a byte-level model."""
        content = json.loads(file)
        model, letters = content["model"], byte_letters()
        ids = model["vocab"]
        special = {t["content"]: t["id"] for t in content["added_tokens"]}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        tokens = {i: bytes(letters[c] for c in t) for t, i in ids.items() if t not in special}
        tokens |= {i: t.encode() for t, i in special.items()}
        return Vocabulary(tokens, [(ids[a], ids[b], ids[a + b]) for a, b in pairs], special)


class Pairs(dict):
    """Which pairs of tokens fit: a table that fills as texts need it."""

    def __init__(self, fits: Callable[[int, int], bool]):
        self.fits = fits

    def __missing__(self, pair: tuple[int, int]) -> bool:
        found = self[pair] = self.fits(*pair)
        return found


class Encoder:
    """Encodes texts with a vocabulary, and decodes ids."""

    def __init__(self, vocabulary: Vocabulary):
        tokens, special = vocabulary.tokens, set(vocabulary.special.values())
        self.rank: dict[tuple[int, int], int] = {}
        # How a token is made: its halves, and the rank of their merge.
        self.halves: dict[int, tuple[int, int]] = {}
        self.made: dict[int, int] = {}
        # A token takes part if merging its own bytes gives it: single bytes, and what fits and is joined in time.
        usable = {t: i for i, t in tokens.items() if len(t) == 1 and i not in special}
        for rank, (left, right, _) in enumerate(vocabulary.merges):
            self.rank.setdefault((left, right), rank)
        for rank, (left, right, whole) in enumerate(vocabulary.merges):
            both = tokens[left] in usable and tokens[right] in usable
            if both and whole not in self.halves and self.fits(left, right, rank):
                self.halves[whole], self.made[whole] = (left, right), rank
                usable[tokens[whole]] = whole
        self.length = {i: len(t) for t, i in usable.items()}
        self.automaton = ahocorasick.Automaton()
        for t, i in usable.items():
            self.automaton.add_word(t.decode("latin-1"), i)
        self.automaton.make_automaton()
        # The next shorter token that a token begins with.
        self.shorter: dict[int, int | None] = {}
        for t, i in usable.items():
            self.shorter[i] = next((usable[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in usable), None)
        self.compatible = Pairs(self.fits)
        #: Remembered pieces and their ids, joined by commas.
        self.kept: dict[str, str] = {}
        self.kept_before: dict[str, str] = {}
        self.special = vocabulary.special
        longest_first = sorted(self.special, key=len, reverse=True)
        self.specials = regex.compile("|".join(map(regex.escape, longest_first))) if self.special else None
        self.pieces, self.ascii_pieces = regex.compile(PIECES), re.compile(ASCII_PIECES)
        # The offset table: where the bytes of each id begin and end.
        most = max(tokens, default=-1) + 1
        self.offsets = np.cumsum([0, *[len(tokens.get(i, b"")) for i in range(most)]])
        self.bytes = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(most)), np.uint8)

    def fits(self, left: int, right: int, before: int | None = None) -> bool:
        """Whether merging leaves tokens ``left`` and ``right`` beside each other; with ``before``, until the
        merge of that rank.

        Only what lies at the border matters. The side that is made last is taken apart first; the half that
        stays at the border stood there until then, so no merge across the border may have an earlier rank.
        """
        while True:
            rank = self.rank.get((left, right))
            if rank is not None and (before is None or rank < before):
                return False
            made_left, made_right = self.made.get(left, -1), self.made.get(right, -1)
            if made_left < 0 and made_right < 0:
                return True
            if made_left > made_right:
                before, left = made_left, self.halves[left][1]
            else:
                # Of the same merges the left one comes first, so across the border it would come first too.
                before, right = made_right + 1, self.halves[right][0]

    def encode_piece(self, piece: bytes) -> list[int]:
        """The tokens of one piece. Each position is left for good once, so the time is linear in its bytes."""
        letters, fit = piece.decode("latin-1"), self.compatible
        if len(fit) > KEPT_PAIRS:
            fit.clear()
        # The longest tokens one after the other, as the automaton walks along; if all fit, they are the ones.
        out = [found[1] for found in self.automaton.iter_long(letters)]
        if all(map(fit.__getitem__, zip(out, out[1:]))):  # noqa: B905
            return out
        n, length, shorter = len(piece), self.length, self.shorter
        if n <= KEPT_CHARS:
            longest, find = None, self.automaton.iter_long
        else:
            # One walk over a long piece finds the longest token at every position: of those that begin at one, longer
            # ones end later.
            longest = array("i", bytes(4 * n))
            for end, token in self.automaton.iter(letters):
                longest[end - length[token] + 1] = token
        dead, at, token, out = bytearray(n + 1), 0, out[0], []
        while at < n:
            end = at + length[token]
            if not dead[end] and (not out or fit[out[-1], token]):
                out.append(token)
                at = end
                if at < n:
                    token = longest[at] if longest else next(find(letters[at:]))[1]
                continue
            token = shorter[token]
            if token is None:
                dead[at] = 1
                token = out.pop()
                at -= length[token]
        return out

    def _joined(self, piece: str) -> str:
        return ",".join(map(str, self.encode_piece(piece.encode())))

    def _plain_parts(self, text: str) -> Iterator[tuple[str, np.ndarray]]:
        """The ids of a text without special texts, joined by commas and as numbers, for some pieces at a time."""
        kept, cut = self.kept, self.ascii_pieces if text.isascii() else self.pieces
        pieces = iter(cut.findall(text) if len(text) <= PART_CHARS else (m.group() for m in cut.finditer(text)))
        while part := list(islice(pieces, PART_PIECES)):
            new = set(part).difference(kept)
            for piece in new:
                kept[piece] = self.kept_before.get(piece) or self._joined(piece)
            joined = ",".join(map(kept.__getitem__, part))
            yield joined, np.fromstring(joined, np.int32, sep=",")
            for piece in new:
                if len(piece) > KEPT_CHARS:
                    del kept[piece]
            if len(kept) > KEPT_PIECES:
                # What is not needed again before this happens the next time is forgotten then.
                self.kept_before = dict(kept)
                kept.clear()

    def parts(self, text: str) -> Iterator[tuple[str, np.ndarray]]:
        """The ids of a text, joined by commas and as numbers, part by part."""
        at = 0
        for found in self.specials.finditer(text) if self.specials else ():
            yield from self._plain_parts(text[at : found.start()])
            special = self.special[found.group()]
            yield str(special), np.array([special], np.int32)
            at = found.end()
        yield from self._plain_parts(text[at:] if at else text)

    def encode(self, text: str) -> list[int]:
        return [i for _, ids in self.parts(text) for i in ids.tolist()]

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        start = self.offsets[ids]
        size = self.offsets[ids + 1] - start
        before = np.cumsum(size) - size
        return self.bytes[np.repeat(start - before, size) + np.arange(int(size.sum()))].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``ids``; bytes that are no UTF-8 become U+FFFD."""
        return self.decode_bytes(np.asarray(ids, np.int64)).decode("utf-8", "replace")

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of tokens of a text, SHA-256 of its ids joined by commas, and of what they decode to.

        Part by part, so that a very long text needs no list of all its tokens.
        """
        n, of_ids, of_text, decoder = 0, hashlib.sha256(), hashlib.sha256(), codecs.getincrementaldecoder("utf-8")("replace")
        for joined, ids in self.parts(text):
            of_ids.update(f"{',' if n else ''}{joined}".encode())
            of_text.update(decoder.decode(self.decode_bytes(ids)).encode())
            n += len(ids)
        of_text.update(decoder.decode(b"", True).encode())
        return n, of_ids.hexdigest(), of_text.hexdigest()


@lru_cache(maxsize=4)
def encoder(content: bytes) -> Encoder:
    """One encoder per vocabulary and Python worker."""
    return Encoder(Vocabulary.read(content))


def file_content(path: str) -> bytes:
    """A tokenizer file, read by the driver; it goes to the tasks with the function, a megabyte or two."""
    with open(path, "rb") as file:
        return file.read()


def encoded(text: Column, path: str) -> Column:
    """The ids of a text column; none for null and empty texts."""
    content = file_content(path)

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: np.array(encoder(content).encode(t or ""), np.int32))

    return ids(text)


def decoded(ids: Column, path: str) -> Column:
    """The text of a column of ids; empty for null."""
    content = file_content(path)

    @F.pandas_udf("string")
    def texts(ids: pd.Series) -> pd.Series:
        return ids.map(lambda i: "" if i is None else encoder(content).decode(i))

    return texts(ids)


def token_digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of every row of ``docs``.

    Whole texts are encoded with the tokenizer file at ``path``, without added tokens (special texts that stand in a
    text are read as their ids), and decoded again. Null texts are empty ones and have no tokens; repeated rows and
    ids have rows of their own; an empty table gives no rows. Further columns are not read.
    """
    content = file_content(path)

    @F.pandas_udf(TOKENS)
    def digests(texts: pd.Series) -> pd.DataFrame:
        # Remembered pieces are many small objects without cycles; looking for any takes a third of the time.
        looked = gc.isenabled()
        gc.disable()
        try:
            rows = [encoder(content).digests(t or "") for t in texts]
        finally:
            if looked:
                gc.enable()
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    found = small_batches(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")))
    return found.select("doc_id", digests("text").alias("found")).select("doc_id", "found.*")

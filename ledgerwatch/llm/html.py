"""Main text of web pages: the best-scoring run of tokens, words for it and tags against it."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.common import hash_sample, saved, small_batches

# Elements whose content is no markup and never text, other elements that are left out if they
# are closed, void elements, and elements that do not end a block.
RAW = "script style textarea title".split()
LEFT_OUT = frozenset("noscript template iframe svg math canvas object video audio select xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
SPACED = frozenset(["br", "img", "hr", "wbr"])
# Elements and words of a class, id or role that tell what is around the article.
AROUND = frozenset("nav header footer aside form button menu dialog fieldset head".split())
AROUND_WORDS = frozenset(
    "ad ads adv adbox adslot adunit banner banners promo promotion promoted leaderboard skyscraper "
    "nav subnav topnav mainnav menu menus topbar toolbar pager "
    "header masthead colophon copyright aside rail complementary contentinfo "
    "consent gdpr notice notices notification alert alerts popup modal overlay subscribe subscription signup login "
    "respond responses replies reply disqus discussion "
    "related recommended recommendations share sharing social teasers outbrain taboola search form hidden".split()
)
AROUND_STEMS = (
    "advert", "sponsor", "comment", "cookie", "sidebar", "sidenav", "navbar", "navigation", "footer", "newsletter", "breadcrumb",
    "pagination", "usercomment",
)
# Those that never name what holds the text, however many words it has: only an element with an article or the page's
# heading in it is not one of these.
NEVER = frozenset(
    "ad ads adv adbox adslot adunit banner banners promo promotion promoted leaderboard skyscraper "
    "nav subnav topnav mainnav menu menus topbar toolbar pager consent gdpr outbrain taboola".split()
)
NEVER_STEMS = ("advert", "sponsor", "cookie", "sidenav", "navbar", "navigation", "breadcrumb", "pagination")
# Those that tell nothing inside an article, where boxes and lists are named so.
NOT_INSIDE = frozenset("alert alerts notice notices notification search form login signup".split())
# Words in front of one of those, or behind it, that make a name tell what the element has or is like, not what it is.
BEFORE = frozenset("has have no not without with hide show category cat tag tags type format overflow long".split())
BEHIND = frozenset("open opened closed enabled disabled allowed on off".split())
# Words that make a header part of an article.
OF_ARTICLE = frozenset("article entry post story content section title".split())
MAIN = frozenset(["article", "main"])
FORMS = frozenset(["form", "fieldset"])  # they often hold whole pages
# Elements whose end tag may be missing, and what ends them.
CLOSED_BY = {
    "p": frozenset(
        "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
        "hr main menu nav ol p pre section table ul li dd dt td th tr".split()
    ),
    "li": frozenset(["li"]),
    "dd": frozenset(["dd", "dt"]),
    "dt": frozenset(["dd", "dt"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "tr": frozenset(["tr"]),
    "option": frozenset(["option"]),
}
BOUNDS = frozenset("ul ol dl table article main section div body nav aside header footer form".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<({'|'.join(RAW)})(?=[\s/>])[^>]*(?<!/)>(?:.*?</\1(?=[\s/>])[^>]*>|.*\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^<>"']|"[^"]*"|'[^']*')*+|[^>]*)>"""
    r"|[^<]+|<",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAME_WORD = re.compile(r"[a-z]+")
HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Block:
    """A run of text that no block element interrupts, and where it is."""

    text: str
    n_words: int
    tags: list[str]  # tags since the block before, as features
    around: str  # what tells that it is not of the article; empty if nothing does
    main: int  # number of the article or main element it is in; 0: none
    linked: int  # words that are inside links


def attributes_of(text: str) -> dict[str, str]:
    """The attributes of a tag by lower-case name; of a repeated one the first."""
    out: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(text) if text else ():
        out.setdefault(name.lower(), next((v for v in values if v), ""))
    return out


def hidden(attributes: dict[str, str]) -> bool:
    if "hidden" in attributes or attributes.get("aria-hidden", "").strip().lower() == "true":
        return True
    return bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", ""), re.IGNORECASE))


def named_around(attributes: dict[str, str]) -> str:
    """The word of a class, id or role that tells that an element is no part of an article, or nothing."""
    for key in ("class", "id", "role"):
        names = [NAME_WORD.findall(HUMP.sub(" ", n).lower()) for n in attributes.get(key, "").split() if ":" not in n]
        of_article = any(not OF_ARTICLE.isdisjoint(words) for words in names)
        for words in names:
            for k, word in enumerate(words):
                if word not in AROUND_WORDS and not word.startswith(AROUND_STEMS) or word == "header" and of_article:
                    continue
                if not (k and words[k - 1] in BEFORE or words[k + 1 : k + 2] and words[k + 1] in BEHIND):
                    return word
    return ""


def never_text(word: str) -> bool:
    return word in NEVER or word.startswith(NEVER_STEMS)


def blocks(page: str, by_class: bool = True) -> list[Block]:
    """All text of a page as blocks, in order; markup, scripts, styles and ``LEFT_OUT`` elements left out.

    An element of these without its own end tag is not left out, as it would take what is behind it along.
    A class, id or role, or a form, does not count where the element holds most of the page's running
    words, those that are neither in links nor in elements that are never of an article; the names of ``NEVER`` do
    count there unless an article or the page's heading is inside. Without ``by_class`` only these tell anything.
    """
    out: list[Block | None] = []
    frames: list[tuple] = []  # for each open element that may be left out the place in ``out`` and what was begun before it
    owners: list[int] = []  # for each block the innermost element that a name tells to be around; 0: none
    above, names, owner = [0], [""], 0  # for each such element the next one around it, and its name
    holds = [False]  # for each such element: whether an article, or a heading of the first rank, is inside
    parts: list[str] = []
    tags: list[str] = []
    stack: list[tuple[str, str, int, int]] = []  # open elements: name, around, main, owner
    opened: Counter[str] = Counter()
    around, main, mains, links, linked = "", 0, 0, 0, 0
    # Behind the last ">" no tag can end; an unfinished one there is markup and goes.
    cut = page.rfind(">") + 1
    tail = re.split(r"<[a-zA-Z/!?]", page[cut:], maxsplit=1)[0]

    def flush() -> None:
        nonlocal parts, tags, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, text.count(" ") + 1, tags, around, main, linked))
                owners.append(owner)
                tags = []
            parts, linked = [], 0

    def close(position: int, ended: bool = False) -> None:
        """Close the open elements from ``position``; ``ended``: the first of them by its own end tag."""
        nonlocal parts, tags, linked, around, main, owner, links
        if any(x[0] not in INLINE for x in stack[position:]):
            flush()
        for k in range(len(stack) - 1, position - 1, -1):
            opened[stack[k][0]] -= 1
            if stack[k][0] in LEFT_OUT:
                place, *begun = frames.pop()
                if ended and k == position:
                    del out[place:], owners[place:]
                    parts, tags, linked = begun
                else:
                    keep(place, *begun, *(stack[k - 1][1:] if k else ("", 0, 0)))
        links = opened["a"]
        del stack[position:]
        around, main, owner = stack[-1][1:] if stack else ("", 0, 0)

    def keep(place: int, parts: list[str], tags: list[str], linked: int, around: str, main: int, owner: int) -> None:
        """Put the block that was begun before an element without end tag where it belongs."""
        text = " ".join("".join(parts).split())
        if text:
            out[place], owners[place] = Block(text, text.count(" ") + 1, tags, around, main, linked), owner

    for token in TOKEN.finditer(page, 0, cut):
        piece = token.group()
        if piece[0] != "<" or piece == "<":
            parts.append(html.unescape(piece) if "&" in piece else piece)
            if links:
                linked += len(piece.split())
            continue
        name = token[3]
        if name is None:
            if piece.startswith("<![CDATA["):
                parts.append(piece[9:].removesuffix("]]>"))
            unfinished = token[1] and not re.search(rf"</{token[1]}(?=[\s/>])[^>]*>\Z", piece, re.IGNORECASE)
            if unfinished or piece.startswith("<!--") and not piece.endswith("-->"):
                tail = ""
            continue
        name = name.lower()
        if name not in LEFT_OUT:
            tags.append(name)
        if name in SPACED:
            parts.append(" ")
        if token[2]:
            for k in range(len(stack) - 1, -1, -1) if opened[name] else ():
                if stack[k][0] == name:
                    close(k, True)
                    break
                if stack[k][0] in BOUNDS and name not in BOUNDS and name not in LEFT_OUT and name not in ("body", "html"):
                    break
            if name not in INLINE and name not in LEFT_OUT:
                flush()
            continue
        for k in range(len(stack) - 1, -1, -1) if any(opened[n] and name in by for n, by in CLOSED_BY.items()) else ():
            open_ = stack[k][0]
            if name in CLOSED_BY.get(open_, ()):
                close(k)
                break
            if open_ in BOUNDS or open_ in LEFT_OUT:
                break
        if name not in INLINE and name not in LEFT_OUT:
            flush()
        if name in VOID or token[4].endswith("/") and name not in INLINE and name not in BOUNDS and name != "p":
            continue
        attributes = attributes_of(token[4])
        own = "hidden" if hidden(attributes) else name if name in AROUND and name not in FORMS else ""
        named = ""
        if by_class and not own and name not in INLINE and name not in ("body", "html"):
            named = name if name in FORMS else named_around(attributes)
        elif not own and name not in INLINE and name not in ("body", "html"):
            named = named_around(attributes)
            named = named if never_text(named) else ""
        inside = main
        if (name in MAIN or "main" in attributes.get("role", "").lower().split()) and not (around or own):
            if not main:
                mains += 1
            inside = main or mains
        if name == "h1" or inside and not main:
            k = owner
            while k and not holds[k]:
                holds[k], k = True, above[k]
        if (own or named) and not around and name not in LEFT_OUT:
            flush()
        if name in LEFT_OUT:
            frames.append((len(out), parts, tags, linked))
            parts, tags, linked = [], [], 0
            out.append(None)
            owners.append(owner)
        if inside:  # the article's own heading
            own, named = ("" if n == "header" else n for n in (own, "" if named in NOT_INSIDE else named))
        within = owner
        if named:
            above.append(owner)
            names.append(named)
            holds.append(False)
            within = len(names) - 1
        stack.append((name, around or own, inside, within))
        around, main, owner = stack[-1][1:]
        opened[name] += 1
        links = opened["a"]
    parts.append(html.unescape(tail))
    flush()
    close(0)
    owners = [k for b, k in zip(out, owners, strict=True) if b]
    out = [b for b in out if b]
    running = [0] * len(names)
    for b, k in zip(out, owners, strict=True):
        running[k] += 0 if b.around else max(0, b.n_words - b.linked)
    for k in range(len(names) - 1, 0, -1):
        running[above[k]] += running[k]
    for k in range(1, len(names)):
        if 2 * running[k] > running[0] and (holds[k] or not never_text(names[k])):
            names[k] = ""  # what holds most of the page is not around it
        names[k] = names[above[k]] or names[k]
    for b, k in zip(out, owners, strict=True):
        b.around = b.around or names[k]
    return out


@dataclass(frozen=True)
class Weights:
    """What tokens add to the score of a region: words are for it, tags against it.

    A word in running text counts one, which sets the scale of all others. ``inside`` comes on top for every word in
    an article or main element, and ``outside`` holds for words outside of them, where these elements are for the region;
    at most ``stretch`` for what lies between two words of the right side, tags included. ``around`` holds
    for words in what is named as no part of an article, once for each stretch of it: such words are left out anyway.
    """

    word: float = 1.0
    link: float = -0.6
    inside: float = 4.0
    outside: float = -2.0
    stretch: float = -30.0
    around: float = -3.0
    tag: float = -0.3
    tags: tuple[tuple[str, float], ...] = ()


def evidence(page: str) -> Counter[str] | None:
    """What a page labelled by an ``article`` or ``main`` element has inside and outside of it: words by kind, and tags
    (``tag_in:p``). None if its text is beside these elements.
    """
    found, out = blocks(page), Counter()
    if side_of_articles(found, Weights()) < 1:
        return None
    for b in found:
        side = "in" if b.main and not b.around else "out"
        out[f"link_{side}"] += b.linked
        out[f"{'around' if b.around else 'word'}_{side}"] += max(0, b.n_words - b.linked)
        # Words of running text by place, whatever they are part of.
        out[f"{'main' if b.main else 'beside'}_{side}"] += b.n_words
        out.update(f"tag_{side}:{t}" for t in b.tags)
    return out


def learned(counts: dict[str, int], smooth: float = 5.0) -> Weights:
    """Weights from the sums of ``evidence``: log odds of being inside, relative to a word in running text.

    Signs are kept as the method demands: a word in running text is for the region, all else against it.
    """
    if not counts.get("word_in"):
        return Weights()
    n_in, n_out = (sum(counts.get(f"{k}_{side}", 0) for k in ("word", "link", "around")) + smooth for side in ("in", "out"))
    odds = lambda k: log((counts.get(f"{k}_in", 0) + smooth) / n_in) - log((counts.get(f"{k}_out", 0) + smooth) / n_out)
    names = sorted({k.split(":", 1)[1] for k in counts if k.startswith("tag_")})
    t_in, t_out = (sum(counts.get(f"tag_{side}:{t}", 0) for t in names) + smooth for side in ("in", "out"))
    share = lambda t, side, n: log((counts.get(f"tag_{side}:{t}", 0) + smooth) / n)
    tags = {t: -0.05 - 0.1 * max(0.0, share(t, "out", t_out) - share(t, "in", t_in)) for t in names}
    return Weights(
        link=max(-1.0, min(-0.2, odds("link") / 4)),
        inside=max(2.0, min(4.0, odds("main"))),
        outside=min(-1.0, odds("beside") / 4),
        around=min(-1.0, odds("around") / 4),
        tag=min(tags.values(), default=-0.3),
        tags=tuple(tags.items()),
    )


def best_region(found: list[Block], weights: Weights, side: int = 0) -> tuple[float, int, int]:
    """The highest sum over contiguous blocks, and where they start and end; of equal ones the first
    and shortest.

    With ``side`` 1 words in article elements are for the region and those out of them against it, with -1
    those inside them are against it.
    """
    costs = dict(weights.tags)
    best, best_span = 0.0, (0, 0)
    total, start, spent = 0.0, 0, 0.0
    for k, b in enumerate(found):
        if total <= 0:
            total, start = 0.0, k
        if b.around:
            total += 0.0 if k and found[k - 1].around else weights.around
            continue
        tags = sum(costs.get(t, weights.tag) for t in b.tags) if total > 0 else 0.0
        if side and (side > 0) != bool(b.main):
            cost = max(weights.stretch - spent, tags + weights.outside * b.n_words)
            spent += cost
            total += cost
            continue
        spent = 0.0
        total += tags
        if total <= 0:
            total, start = 0.0, k
        total += weights.word * (b.n_words - b.linked) + weights.link * b.linked
        if side > 0:
            total += weights.inside * b.n_words
        if total > best:
            best, best_span = total, (start, k + 1)
    return best, *best_span


def side_of_articles(found: list[Block], weights: Weights) -> int:
    """Whether a page's article elements are for its region (1), against it (-1) or tell nothing (0).

    They are for it if one of them is worth as much as the best run of text outside, or all of them are
    and one is worth half; being in an article counts. They are against it (teasers beside the text) if all are worth
    less than that run and each less than half of it.
    """
    worth: Counter[int] = Counter()
    for b in found:
        if not b.around:
            inside = weights.inside * b.n_words if b.main else 0.0
            worth[b.main] += weights.word * (b.n_words - b.linked) + weights.link * b.linked + inside
    worth[0] = 0
    if len(worth) == 1:
        return 0
    largest, together = max(worth.values()), sum(max(0.0, w) for w in worth.values())
    outside = best_region(found, weights, -1)[0]
    if outside <= largest or outside <= together and outside <= 2 * largest:
        return 1
    return -1 if outside > together and outside > 2 * largest else 0


def extract(page: str | None, weights: Weights) -> str:
    """The main text of a page: the blocks of its best region that are not named as something else.

    A linear scan finds the contiguous run of tokens with the highest sum. Being in an article or main element is
    a weight in it, for or against, as these compare with the text outside. Of equally good regions the first and
    shortest is taken. A page without any text gives an empty text; if no word is for the region, nothing is
    extracted.
    """
    found = blocks(page or "")
    if 10 * sum(b.n_words for b in found if not b.around) < sum(b.n_words - b.linked for b in found if b.around != "hidden"):
        found = blocks(page or "", by_class=False)  # names on nearly all of a page tell nothing
    _, start, end = best_region(found, weights, side_of_articles(found, weights))
    return "\n".join(b.text for b in found[start:end] if not b.around)


def main_text(page: Column, weights: Weights) -> Column:
    """The main text of a column of whole pages; null pages are empty ones."""

    @F.pandas_udf("string")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([extract(p, weights) for p in pages], dtype=object)

    return extracted(page)


def train_weights(pages: DataFrame, sample: int = 500, page: str = "html") -> Weights:
    """Weights from at most ``sample`` labelled pages, those first in a hash order; copies count once.

    The pages are read where they are; the driver gets the sums of what they show.
    """
    rows = pages.select(F.col(page).alias("text")).where("text rlike '(?i)<(article|main)[ >]'")
    places = rows.selectExpr("true as kind", "xxhash64(text) as place")
    chosen = F.broadcast(hash_sample(saved(places), sample).select("place"))
    one = rows.withColumn("place", F.xxhash64("text")).join(chosen, "place").groupBy("place").agg(F.min("text").alias("text"))

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sums: Counter[str] = Counter()
            for text in batch["text"]:
                sums.update(evidence(text) or {})
            yield pd.DataFrame(list(sums.items()), columns=["name", "n"]).astype({"n": "int64"})

    found = small_batches(one).mapInPandas(counts, "name string, n bigint").groupBy("name").agg(F.sum("n").alias("n"))
    return learned({r["name"]: r["n"] for r in found.collect()})


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages(page_id, url, html)``.

    Null and empty pages have an empty text. Repeated rows give repeated results; other columns are ignored. An empty
    table gives no rows.
    """
    weights = train_weights(pages)
    texts = small_batches(pages).select("page_id", "url", main_text(F.col("html"), weights).alias("text"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))

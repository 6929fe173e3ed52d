import html
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from ledgerwatch.llm import html as pages
from ledgerwatch.llm import queries

WEIGHTS = pages.Weights()
PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header class="site"><a href=/>Home</a> My site</header>
<div id="menu"><ul><li><a>One</a><li><a>Two</a></ul></div><div class="cookie-notice">We use cookies. Accept them all now</div>
<div class="c"><h1>Head line</h1><p>The first para has some words &amp; more.<p>Second para with <a href=x>a link</a> inside
 and text<ul><li>item one is here<li>item two</ul><div class="advert">Buy cheap things</div><script>var x = "<p>no</p>"</script>
<p>Third and last para of the te<b>x</b>t.</div><aside>Side bar with words</aside><form><input>Sign up here</form>
<section id="comments"><h2>Comments</h2><p>I like this article very much, the best one I ever read.</p></section>
<footer>(c) 2024</footer></body></html>"""
TEXT = """Head line
The first para has some words & more.
Second para with a link inside and text
item one is here
item two
Third and last para of the text."""


def test_page_without_and_with_article():
    assert pages.extract(PAGE, WEIGHTS) == TEXT
    main = PAGE.replace('<div class="c">', "<article>").replace("te<b>x</b>t.</div>", "te<b>x</b>t.</article>")
    assert pages.extract(main, WEIGHTS) == TEXT


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("plain &lt;text&gt; only", "plain <text> only"),
        ("<p>a<p>b", "a\nb"),
        ("<article>x &nbsp; y<br>z</article>", "x y z"),
        ("<script>var x='<p>no</p>'", ""),
        ("a<!-- x > y", "a"),
        ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
        ("<div hidden>no</div><p>yes yes</p>", "yes yes"),
        ("<div class='layout with-sidebar'><form><p>all of it</p></form></div>", "all of it"),
        ("<div class='entry-header'><h1>T</h1></div><p>one two three</p><div class='ReaderComments'>x y</div>", "T\none two three"),
        ("<p>one two three four</p><div role='complementary'>x y</div><p>five six seven eight</p>", "one two three four\nfive six seven eight"),
        ("<article><header><h1>T</h1></header><p>b c</p><article class='comment'>c d</article></article>", "T\nb c"),
    ],
)
def test_small_pages(page, text):
    assert pages.extract(page, WEIGHTS) == text


TWELVE = " ".join(["word"] * 12)


def test_short_articles_and_boxes_in_articles():
    assert pages.extract(f"<article><h1>A</h1><p>x y z</p></article><div>{TWELVE}</div>", WEIGHTS) == "A\nx y z"
    boxes = "<section class='alert-box'>note this</section><div class='search-results'>one result</div>"
    page = f"<article><p>{TWELVE}</p>{boxes}<p>{TWELVE}</p></article>"
    assert pages.extract(page, WEIGHTS) == f"{TWELVE}\nnote this\none result\n{TWELVE}"


@pytest.mark.parametrize("name", ["ad", "advert-top", "sponsored", "cookie-bar", "mainnav", "promo"])
def test_adverts_that_hold_most_of_a_page(name):
    """However many words an advert has, it is no text; only what has an article or the heading in it may be."""
    advert = f"<div class='{name}'><p>{TWELVE}</p><p>{TWELVE}</p></div>"
    for article in ("<article><h1>A</h1><p>x y z</p></article>", "<div><h1>A</h1><p>x y z</p></div>"):
        assert pages.extract(f"<body>{advert}{article}{advert}</body>", WEIGHTS) == "A\nx y z"
    assert pages.extract(f"<div class='{name}'><h1>A</h1><p>{TWELVE}</p></div>", WEIGHTS) == f"A\n{TWELVE}"


def sum_of(found, weights, side, start, end):
    """The score of the blocks from ``start`` to ``end``, as the scan adds it up; None if the run starts with nothing."""
    costs, total, spent = dict(weights.tags), 0.0, 0.0
    for k in range(start, end):
        b = found[k]
        if b.around:
            total += 0.0 if k and found[k - 1].around else weights.around
            continue
        tags = sum(costs.get(t, weights.tag) for t in b.tags) if k > start else 0.0
        if side and (side > 0) != bool(b.main):
            cost = max(weights.stretch - spent, tags + weights.outside * b.n_words)
            total, spent = total + cost, spent + cost
            continue
        total, spent = total + tags + weights.word * (b.n_words - b.linked) + weights.link * b.linked, 0.0
        total += weights.inside * b.n_words if side > 0 else 0.0
    return total


def test_best_region_equals_all_intervals():
    draw = random.Random(4)
    for trial in range(400):
        weights = pages.Weights(tags=(("p", -0.25), ("div", -2.0)), stretch=-8.0)
        found = []
        for _ in range(draw.randint(0, 9)):
            n = draw.randint(1, 6)
            tags = draw.choices(["p", "div", "b"], k=draw.randint(0, 4))
            found.append(pages.Block("x", n, tags, draw.choice(["", "", "ad"]), draw.choice([0, 1]), draw.randint(0, n)))
        side = draw.choice([-1, 0, 1])
        # A best run starts with a block that is for it.
        sums = [sum_of(found, weights, side, a, b) for a in range(len(found)) for b in range(a + 1, len(found) + 1)]
        score, start, end = pages.best_region(found, weights, side)
        assert score == pytest.approx(max([0.0, *sums]))
        if start < end:
            assert sum_of(found, weights, side, start, end) == pytest.approx(score)


def test_weights_are_learned_where_the_pages_are(spark, medium):
    table = spark.read.parquet(f"{medium}/pages.parquet")
    own = pages.Counter()
    for r in table.select("html").distinct().collect():
        own.update(pages.evidence(r.html) or {})
    assert pages.train_weights(table, sample=10_000) == pages.learned(own)
    assert pages.train_weights(table.unionByName(table), sample=10_000) == pages.learned(own)
    assert pages.train_weights(table.limit(0)) == pages.Weights()
    few = pages.train_weights(table, sample=20)
    assert few.link < 0 and few.outside < 0 and all(w < 0 for _, w in few.tags) and few.inside >= 2


BODY = "the whole article has these running words and some more of them"


@pytest.mark.parametrize(
    "tag",
    [
        *(f"div class='{c}'" for c in ("post comments-open", "container has-sidebar", "no-sidebar", "long-form", "category-notices")),
        *("div class='overflow-hidden'", "div class='md:hidden'", "div class='comments'", "form", "article class='comments-open'"),
        *("div title='the hidden truth'", "div data-hidden='false'", "div data-id='comment-7'", "div data-role=\"x role='nav'\""),
    ],
)
def test_names_do_not_drop_what_holds_the_page(tag):
    page = f"<body><{tag}><p>{BODY}</p><div class='comment'>me too</div></{tag.split()[0]}><div>(c) 2024</div></body>"
    text = pages.extract(page, WEIGHTS)
    assert text.startswith(BODY) and "me too" not in text


def test_weak_names_do_not_drop_a_part():
    for tag in ("div class='post comments-open'", "section class='long-form'", "div data-id='comment-7'"):
        page = f"<p>{BODY}</p><p>{BODY}</p><{tag}><p>{BODY}</p></{tag.split()[0]}><p>{BODY}</p><div class='comments'>no no</div>"
        assert pages.extract(page, WEIGHTS) == "\n".join([BODY] * 4)


@pytest.mark.parametrize("card", ["read on here", "<a href=x>read on here</a>", "<h2>Other</h2><p>read on here</p>"])
def test_text_beside_teasers(card):
    body, cards = "".join(f"<p>{BODY}</p>" for _ in range(8)), f"<article>{card}</article>" * 3
    for page in (f"<div>{body}</div><div>{cards}</div>", f"<div>{cards}</div><div>{body}</div>"):
        assert pages.extract(page, WEIGHTS) == "\n".join([BODY] * 8)
    assert pages.extract(f"{body}{cards}{body}", WEIGHTS).count(BODY) == 16


def test_articles_in_parts():
    part, between = f"<article><p>{BODY}</p><p>{BODY}</p><p>{BODY}</p></article>", f"<div>{BODY}</div>"
    text = pages.extract(f"<div>Site name</div>{part}{between}{part}{between}{part}<div>Last line</div>", WEIGHTS)
    assert text == "\n".join([BODY] * 11)
    index = f"<div>About us</div>{(f'<article><p>{BODY}</p></article>') * 9}<div>{BODY} and {BODY}</div>"
    assert pages.extract(index, WEIGHTS).count(BODY) >= 9


@pytest.mark.parametrize("name", ["video-js", "svg-icon", "title-bar", "select-box", "template-x", "script-x", "style-x", "object_"])
def test_custom_elements_are_no_raw_elements(name):
    assert pages.extract(f"<p>one two<{name} a=b>three</{name}> four<p>five six", WEIGHTS).split() == "one two three four five six".split()
    assert "five six" in pages.extract(f"<p>one two<{name} a=b><p>five six", WEIGHTS)


@pytest.mark.parametrize("name", sorted(pages.LEFT_OUT))
def test_left_out_elements(name):
    assert pages.extract(f"<p>one two <{name} a=b>x <p>y</p><{name}>z</{name}></{name.upper()} >three</p>four", WEIGHTS) == "one two three\nfour"
    assert pages.extract(f"<p>one two <{name} a=b><p>three</p>four <b>five</b><p>six", WEIGHTS) == "one two\nthree\nfour five\nsix"
    assert pages.extract(f"<div>one <{name}>two</div><p>three <{name}>x</{name}>four", WEIGHTS) == "one\ntwo\nthree four"


def test_left_out_elements_take_linear_time():
    began = time.perf_counter()
    for page in ("<select>" * 50_000 + "x", "a <video>" * 50_000, "a <svg><p>" * 50_000, "<svg>" * 50_000 + "a</svg>" * 50_000, "<object></object" * 50_000):
        pages.extract(page, WEIGHTS)
    assert time.perf_counter() - began < 20


def test_hostile_pages_take_linear_time():
    began = time.perf_counter()
    for page in ("<" * 100_000, "<a " * 100_000, '<a b="' * 50_000, "<script>" * 50_000, "<div>" * 100_000 + "x", "<b>" * 50_000 + "<p>" * 50_000):
        pages.extract(page, WEIGHTS)
    assert time.perf_counter() - began < 20


def test_query(spark, medium):
    rows = queries.op9_html(spark, medium).toPandas().set_index("page_id")
    for r in spark.read.parquet(f"{medium}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [html.unescape(re.sub("<[^>]*>", " ", re.sub("</?b>", "", b))) for b in re.split(r"</?(?:p|h1)>", article)]
        text = "\n".join(" ".join(b.split()) for b in blocks if b.strip())
        assert (rows.text[r.page_id], rows.n_chars[r.page_id], rows.url[r.page_id]) == (text, len(text), r.url)


def test_odd_rows(spark):
    rows = [(1, "u", None), (1, "u", None), (None, None, ""), (2, "v", PAGE), (3, "w", "<p>" + "word " * 100_000)]
    odd = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("kind", F.lit(2))
    found = pages.extract_pages(odd).toPandas()
    assert sorted(found.n_chars) == [0, 0, 0, len(TEXT), 499_999]
    assert pages.extract_pages(odd.limit(0)).count() == 0

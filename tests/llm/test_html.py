import html
import random
import re
import time

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from abtforge.llm import html_text
from conftest_llm import SF_SMALL

LONG = "The house on the hill is old and the people of the town have not been in it for a very long time, but they say that it was once full of light and of music."
MORE = "In the winter the road to it is closed with snow, and only the man who brings the post will go up there, with his dog and a lamp, to see that all is as it was."
GERMAN = "Das Haus auf dem Berg ist alt und die Leute aus dem Dorf sind nicht mehr da, denn der Weg ist im Winter zu und es gibt für sie dort nichts zu tun oder zu holen."


def articles(page):
    """The article text of the given pages, by their one template."""
    inner = re.search(r"(?s)<article>(.*)</article>", page)[1].replace("<b>", "")
    parts = (" ".join(html.unescape(x).split()) for x in re.split(r"</?(?:p|h1|br)>", inner))
    return " ".join(x for x in parts if x)


def test_given_pages_are_extracted_exactly(spark):
    rows = html_text.extract_pages(spark.read.parquet(f"{SF_SMALL}/pages.parquet").withColumn("text", F.lit("x"))).collect()
    pages = pq.read_table(f"{SF_SMALL}/pages.parquet").to_pylist()
    assert sorted((r.page_id, r.url, r.text, r.n_chars) for r in rows) == sorted((p["page_id"], p["url"], t, len(t)) for p in pages for t in [articles(p["html"])])


CASES = {
    "menus, notices, comments and footers around an article": (
        f"<html><head><title>T</title></head><body class='no-sidebar'><header><h1>The Site</h1><p>{LONG}</p></header><nav><a href=/>Home</a></nav>"
        f"<div class='cookie-notice'><p>We use cookies. {MORE}</p></div><main><article><header><h1>The house</h1></header><p>{LONG}<p>{MORE}"
        f"<div class='ad'>Buy the lamp of the year and be happy with it.</div><p>So it is.</p></article></main><aside><p>{GERMAN}</p></aside>"
        f"<section id='comments'><article class='comment'><p>{GERMAN}</p></article></section><footer>&copy; 2020</footer>", f"The house {LONG} {MORE} So it is."),
    "no article element: densities and neighbours decide": (
        f"<div class=top><a href=a>One</a> <a href=b>Two</a> <a href=c>Three</a></div><div id=content><h2>The old house</h2><p>{LONG}</p><p>Yes, it is.</p><p>{MORE}</p></div>"
        "<div>Lamps: 20 EUR, 30 EUR, 40 EUR, delivered anywhere within 24 hours, order number 1234567890, item code XK-2000-B, VAT included, batteries excluded, call 555-1234</div>"
        "<div>&copy; 2021 House Press</div>", f"The old house {LONG} Yes, it is. {MORE}"),
    "entities, white space and markup": (
        f"<article><p>{LONG}</p><p>a&nbsp;&amp;\n\t b&lt;c&gt; <b>bo</b>ld &#8364;&#x41; &amp;lt; 1 < 2 <3 &am</p><!-- <p>no</p> --><script>var x='</p><p>no</p>';</script><style>p{{}}</style></article>",
        f"{LONG} a & b<c> bold €A &lt; 1 < 2 <3 &am"),
    "an article of short blocks only": ("<nav><a href=/>Home</a></nav><article><h1>Of it</h1><p>Sh is.</p></article><footer>x</footer>", "Of it Sh is."),
    "nothing is closed": (f"<body><ul><li><a href=1>Home<li><a href=2>News</ul><div><p>{LONG}<p>{MORE}<div class=footer>All the rights of the house", f"{LONG} {MORE}"),
    "a menu that is never closed": (f"<nav><ul><li><a href=/>Home</a><article><p>{LONG}</p></article>", LONG),
    "forms and hidden text": (f"<article><p>{LONG}</p><form><p>{MORE}</p><input value='x>y'></form><p hidden>{MORE}</p><p style='display: none'>{MORE}</p><button>Go</button></article>", LONG),
    "names on the page's wrapper do not rule it out": (f"<div class='menu'><div><p>{LONG}</p><p>{MORE}</p></div></div>", f"{LONG} {MORE}"),
    "plain text": (LONG, LONG),
    "a comment that is never closed": (f"<p>{LONG}</p><!-- {MORE}", LONG),
    "a script that is never closed": (f"<p>{LONG}</p><script> {MORE}", LONG),
    "quotes in tags": (f"<article><p title=\"a>b\" data-x='<p>'>{LONG}</p><p title=\"open>{MORE}</p></article>", f"{LONG} {MORE}"),
    "links inside text are text": (f"<article><p>{LONG} <a href=x>See there</a>.</p><ul><li><a href=y>Other lamps and houses</a></li></ul></article>", f"{LONG} See there."),
    "only a menu": ("<nav><a href=/>Home</a></nav>", ""),
    "blanks": (" \n\t", ""),
    "empty": ("", ""),
}


def test_pages_by_hand():
    for name, (page, want) in CASES.items():
        assert html_text.main_text(page) == want, name


def test_nearest_neighbour_decides_by_boundaries_then_blocks():
    block = lambda label, depth, low, text="x", heading=False: html_text.Block(text, 0, depth, low, heading, False, False, 0, label)
    nearer = [block(True, 3, 3), block(None, 3, 2), block(False, 3, 1)]
    html_text.second_pass(nearer, False)
    assert [b.label for b in nearer] == [True, True, False]
    for text, heading, want in (("lamp", False, False), ("the of and", False, True), ("the of and", True, False)):
        even = [block(True, 2, 2), block(None, 2, 1, text, heading), block(False, 2, 1)]
        html_text.second_pass(even, False)
        assert even[1].label is want
    for _ in range(200):  # against a search over all pairs
        rng = random.Random(_)
        blocks, low = [], 1
        for i in range(rng.randrange(1, 12)):
            depth = rng.randrange(1, 5)
            blocks.append(block(rng.choice([True, False, None]), depth, rng.randrange(1, min(depth, low if i else depth) + 1), rng.choice(["the", "x"]), rng.random() < 0.2))
            low = depth
        labels = [b.label for b in blocks]

        def distance(i, j):
            lowest = min(b.low for b in blocks[min(i, j) + 1:max(i, j) + 1])
            return blocks[i].depth + blocks[j].depth - 2 * lowest, abs(i - j)

        want = []
        for i, b in enumerate(blocks):
            one = next((j for j in range(i - 1, -1, -1) if labels[j] is not None), None)
            other = next((j for j in range(i + 1, len(blocks)) if labels[j] is not None), None)
            near = [j for j in (one, other) if j is not None]
            if labels[i] is not None or not near:
                want.append(labels[i])
            elif len({labels[j] for j in near}) == 1:
                want.append(labels[near[0]])
            elif distance(i, one) != distance(i, other):
                want.append(labels[min(near, key=lambda j: distance(i, j))])
            else:
                want.append(labels[other] if b.heading else b.text == "the")
        html_text.second_pass(blocks, False)
        assert [b.label for b in blocks] == want


def test_awkward_pages(spark):
    long_page = "<article>" + "".join(f"<p>{LONG} {i}</p><p>{i}</p>" for i in range(20_000)) + "</article>"
    rows = [(1, None, None), (1, "u", ""), (None, None, f"<p>{LONG}</p>"), (3, "u", f"<p>{LONG}</p>"), (3, "u", f"<p>{LONG}</p>"), (4, "u", long_page),
            (5, "u", "<" * 50_000), (6, "u", '<a "' * 20_000), (7, "u", "<div>" * 20_000 + LONG), (8, "u", "&" * 1000 + "\x00\x7f")]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("n_chars", F.lit("x"))
    started = time.time()
    got = html_text.extract_pages(docs).collect()
    assert time.time() - started < 60
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by_id = {r.page_id: r.text for r in got}
    assert by_id[None] == by_id[3] == by_id[7] == LONG and [r.text for r in got if r.page_id == 1] == ["", ""]
    assert by_id[4] == " ".join(f"{LONG} {i} {i}" for i in range(20_000))
    assert html_text.extract_pages(docs.where("page_id = 99")).collect() == []

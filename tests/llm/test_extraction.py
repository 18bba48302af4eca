"""Main text of hand-written pages, and both passes on label strings."""

import html
import random
import time

import pytest
from pyspark.sql import functions as F

from textguard.llm.blocks import page_blocks
from textguard.llm.extraction import extract, spread_labels

PROSE = (
    "The house on the hill was built in the last century and it has been the home of "
    "many families that came from the valley and from the towns by the river."
)
MORE = "It was for the most part empty, as they have not the means to be there, or so it is said in the town."
ADVERT = "Buy cheap carpets today! Best prices, free delivery, order online, limited offer, click here quickly now"

PAGES = {
    "plain": (f"<p>{PROSE}</p><p>{MORE}", [PROSE, MORE]),
    "null": (None, []),
    "empty": ("", []),
    "no element": ("Hello world", ["Hello world"]),
    "marked": (
        f"<html><head><title>T</title><style>p{{}}</style></head><body><header><h1>Site</h1></header>"
        f"<nav><a href=/>{PROSE}</a></nav><div class='cookie-notice'>{PROSE}</div><article><h1>Head</h1>"
        f"<p>{PROSE}<p><b>Short.<br>Line<div class='ad'>{MORE}</div><form>{MORE}</form><ul><li>One<li>Two</ul>"
        f"<section id=comments><p>{PROSE}</p></section></article><aside>{MORE}</aside><footer>{PROSE}</footer>",
        ["Head", PROSE, "Short. Line", "One", "Two"],
    ),
    "short article": ("<div class=ad>x</div><article><h1>T</h1><p>word</p></article><footer>f", ["T", "word"]),
    "header within": (
        f"<article><header><h1>Head</h1><p>By me</p></header><p>{PROSE}</p><footer>{MORE}</footer></article>",
        ["Head", PROSE],
    ),
    "never closed": (f"<div class='ad'>{MORE}<article><p>{PROSE}</article>", [PROSE]),
    "teasers": (
        f"<article><p>{PROSE}</article><div class=sidebar><article><p>{MORE}</article></div>",
        [PROSE],
    ),
    "references": (
        "<article>a &lt;b&gt; &amp;amp; &eacute;&nbsp;&#8364;\n\t x&quot</article>",
        ['a <b> &amp; é € x"'],
    ),
    "scripts": (
        f"<article><script>var a='</article>';if(a<b){{}}</script><!-- <p>{MORE} --><p>{PROSE}</p>"
        f"<noscript>{MORE}</noscript><p title='a>b' hidden>{MORE}</p></article>",
        [PROSE],
    ),
    "links": (
        f"<div><h2>Head</h2><p>{PROSE}</p><p>{MORE}</p></div><div><p><a href=/a>{PROSE}</a><p>See also</p>"
        f"<a href=/b>{MORE}</a></div>",
        ["Head", PROSE, MORE],
    ),
    "few stop words": (f"<p>{PROSE}</p><p>{MORE}</p><p>{ADVERT}</p><p>Order now</p>", [PROSE, MORE]),
    "table": ("<article><p>" + PROSE + "</p><table><tr><td>12<td>Carpets</table></article>", [PROSE, "12", "Carpets"]),
    "signs": ("<article><p>a < b and c > d <3 </p></article>", ["a < b and c > d <3"]),
}


def test_pages(spark):
    rows = [(name, "u", page, "x", "y") for name, (page, _) in PAGES.items()]
    df = spark.createDataFrame(rows, "page_id string, url string, html string, text string, n_chars string")
    out = {row.page_id: row for row in extract(df).collect()}
    for name, (_, blocks) in PAGES.items():
        assert out[name].text.split("\n\n") == (blocks or [""]), name
        assert out[name].n_chars == len("\n\n".join(blocks))


def test_empty_table_repeats_and_long_pages(spark):
    schema = "page_id long, url string, html string"
    assert extract(spark.createDataFrame([], schema)).count() == 0
    long = "".join(f"<p>{html.escape(PROSE)} {i}" for i in range(5000))
    df = spark.createDataFrame([(None, None, long), (None, None, long)], schema)
    rows = extract(df).collect()
    assert len(rows) == 2 and rows[0] == rows[1]
    assert rows[0].text.split("\n\n") == [f"{PROSE} {i}" for i in range(5000)]


def by_hand(labels):
    decided = [i for i, c in enumerate(labels) if c != "A"]
    out = []
    for i, c in enumerate(labels):
        left = max((j for j in decided if j < i), default=None)
        right = min((j for j in decided if j > i), default=None)
        if c != "A":
            out.append(c)
        elif left is None and right is None:
            out.append("G")
        elif left is None or right is None or labels[left] == labels[right]:
            out.append(labels[right if left is None else left])
        elif i - left == right - i:
            out.append("T")
        else:
            out.append(labels[left] if i - left < right - i else labels[right])
    return "".join(out)


def test_second_pass(spark):
    rng = random.Random(1)
    labels = ["".join(rng.choice("AAAGB") for _ in range(rng.randrange(25))) for _ in range(500)]
    df = spark.createDataFrame([(label,) for label in labels], "labels string")
    got = {row[0]: row[1] for row in df.select("labels", spread_labels(F.col("labels"))).collect()}
    assert all(got[label] == by_hand(label) for label in labels)


@pytest.mark.parametrize(
    "part", ["<", "<a href=\"", "<!--", '<p class="ad">', "</div>", "<div></b>", "<a x='\"=", "<script>", "<b>"]
)
def test_broken_pages_take_linear_time(part):
    began = time.time()
    page_blocks(part * 50_000, frozenset())
    assert time.time() - began < 5

from __future__ import annotations

import html
import re

import pytest

from skyfare.llm.html_text import best_run, extract_text, learn_weights, main_text
from tests.llm.conftest import SF_DIR


def article(source):
    """What the test pages hold between the article's tags, cut at its blocks."""
    inside = re.sub(r"<[^>]*\Z", "", source.split("<article>", 1)[1].split("</article>")[0])
    blocks = re.split(r"</?p>|</?h1>", re.sub(r"</?b>", "", inside.replace("<br>", " ")))
    return "\n\n".join(t for t in (" ".join(html.unescape(b).split()) for b in blocks) if t)


def test_pages(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    want = {r.page_id: article(r.html) for r in pages.collect()}
    rows = extract_text(pages).collect()
    assert {r.page_id: r.text for r in rows} == want
    assert all(r.n_chars == len(r.text) for r in rows)


def test_best_run_against_all_runs():
    import random

    rng = random.Random(2)
    for _ in range(300):
        scores = [rng.randint(-4, 4) for _ in range(rng.randint(0, 12))]
        start, end = best_run(scores)
        sums = [sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
        assert sum(scores[start:end]) == max([0, *sums])


WORDS = "Plain words of the article go on and on for quite a while here. " * 3


@pytest.mark.parametrize(
    ("body", "want"),
    [
        ("", ""),
        ("<p>a", "a"),
        (f"<main><p>{WORDS}</p></main>", WORDS.strip()),
        ("<article><p>x &amp; y&nbsp;&#233; &lt;b&gt;</p><p>two\n  lines<br>more</p></article>", "x & y é <b>\n\ntwo lines more"),
        (f"<nav><ul><li><a>Menu</a></li></ul></nav><div class='post'><h1>Head</h1><p>{WORDS}</p></div><footer>foot</footer>", f"Head\n\n{WORDS.strip()}"),
        (f"<article><p>{WORDS}</p><aside>side</aside><div class='ad'>buy</div><form>mail <input></form><p>{WORDS}</p></article>", f"{WORDS.strip()}\n\n{WORDS.strip()}"),
        (f"<article><p>{WORDS}</p></article><section class='comments'><article class='comment'><p>{WORDS}</p></article></section>", WORDS.strip()),
        (f"<article><header><h1>Title</h1></header><p>{WORDS}</p><div id='cookie-notice'>we use cookies</div></article>", f"Title\n\n{WORDS.strip()}"),
        (f"<form><article><p>{WORDS}</p></article></form>", WORDS.strip()),
        (f"<article><script>var t = '</p><p>no';</script><style>p{{}}</style><!-- <p>no</p> --><p>{WORDS}", WORDS.strip()),
        ("<article><p>one<p>two<li>three</article", "one\n\ntwo\n\nthree"),
        (f"<article><p>a < b and c > d</p></article>", "a < b and c > d"),
        ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a b\n\nc"),
        (f"<header><p>{WORDS}</p></header><article><p hidden>no</p><p>yes</p></article>", "yes"),
    ],
)
def test_markup(body, want):
    assert main_text(body, {}) == want


def test_odd_rows(odd, none):
    for df, n in ((odd, odd.count()), (none, 0)):
        pages = df.drop("html", "text").withColumnRenamed("doc_id", "page_id").withColumnRenamed("label", "url")
        from pyspark.sql import functions as F

        pages = pages.withColumn("html", F.when(F.col("page_id") > 3, F.lit("<p>text <b>bold")).otherwise(F.lit(None)))
        pages = pages.withColumn("text", F.lit("clash"))
        rows = extract_text(pages).collect()
        assert len(rows) == n
        assert {r.text for r in rows} <= {"", "text bold"}


def test_long_and_broken_pages_end():
    assert main_text("<div " * 20_000, {}) == ""
    assert main_text("<p class=\"" * 5_000, {}) == ""
    assert len(main_text("<article>" + "<p>word</p>" * 50_000, {})) == 50_000 * 6 - 2
    assert main_text("<div>" * 50_000 + "deep", {}) in ("", "deep")


MANY = "other words " * 50
NO_CONTENT = [
    f"<aside>{MANY}</aside>",
    f"<div class='ad'><p>{MANY}</p></div>",
    f"<form><p>{MANY}</p><input><button>send</button></form>",
    f"<div class='comments'><ol>{'<li><p>I say so too</p></li>' * 25}</ol></div>",
    f"<nav><ul>{'<li><a>Menu</a></li>' * 100}</ul></nav>",
]
LEARNED = {"in word text": 5.0, "out word aside": -5.0, "out word text": -5.0, "out tag li": -5.0}


@pytest.mark.parametrize("weights", [{}, LEARNED])
@pytest.mark.parametrize("part", NO_CONTENT)
def test_long_parts_inside_an_article_part_nothing(part, weights):
    body = f"<article><h1>Head</h1><p>a short intro</p>{part}<p>a longer middle of it</p>{part}<p>the end</p></article>"
    assert main_text(f"<body><nav>menu</nav>{body}<footer>foot</footer>", weights) == "Head\n\na short intro\n\na longer middle of it\n\nthe end"


def test_long_menu_between_articles():
    body = f"<article><p>the smaller</p></article>{NO_CONTENT[-1]}<article><p>{WORDS}</p></article><p>not this</p>"
    assert main_text(body, LEARNED) == f"the smaller\n\n{WORDS.strip()}"


@pytest.mark.parametrize(
    ("body", "want"),
    [
        (f"<div class='right-sidebar'><div><main><p>{WORDS}</p></main></div><div class='sidebar'>{MANY}</div></div>", WORDS.strip()),
        (f"<div class='content-sidebar'><article><h1>Head</h1><p>{WORDS}</p></article><aside>{MANY}</aside></div>", f"Head\n\n{WORDS.strip()}"),
        (f"<div class='layout-with-sidebar'><article><p>{WORDS}</p></article></div>", WORDS.strip()),
        (f"<div class='no-js hidden-print'><article><p>{WORDS}</p></article></div>", WORDS.strip()),
        (f"<form><div class='sidebar-left'><main><p>{WORDS}</p></main></div></form>", WORDS.strip()),
        (f"<article><p>one</p><section class='alert-history'><p>{WORDS}</p></section><p>two</p></article>", f"one\n\n{WORDS.strip()}\n\ntwo"),
        (f"<article><p>one</p><div class='search-results'><p>{WORDS}</p></div></article>", f"one\n\n{WORDS.strip()}"),
        (f"<nav>menu</nav><div class='widget'><p>{WORDS}</p></div>", WORDS.strip()),
        (f"<article><p>one</p></article><section class='related-posts'><article><p>{WORDS}</p></article></section>", "one"),
        (f"<div class='post'><p>one</p></div><div id='comments-area'><article><p>{WORDS}</p></article></div>", "one"),
        (f"<article><p>one</p><div class='newsletter-box'><p>{WORDS}</p></div><div id='cookie-law-info'>we</div></article>", "one"),
    ],
)
def test_names_leave_out_no_content(body, want):
    assert main_text(body, {}) == want


def test_weights_come_from_the_pages_that_name_their_content(spark):
    """Few among many that name none, or only seem to."""
    none = ["<p>plain", "<!-- <article> --><p>plain", "<div hidden><article>no</article></div>"]
    rows = [(i, f"<nav><a>menu</a></nav><article><p>{WORDS}</p></article>" if i % 100 == 0 else none[i % 3]) for i in range(1000)]
    pages = spark.createDataFrame(rows, "page_id bigint, html string")
    want = learn_weights(pages.filter("page_id % 100 = 0"), 20)
    assert want and learn_weights(pages, 20) == want


SECTION = "What we found in the end is told in plain words here. " * 8
NAMES = "discussion responses feedback social login related".split()


@pytest.mark.parametrize("weights", [{}, LEARNED])
@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("kind", ["id", "class"])
def test_section_that_is_most_of_an_article_stays(name, kind, weights):
    body = f"<article><h1>Head</h1><p>short intro</p><section {kind}='{name}'><h2>Title</h2><p>{SECTION}</p></section><p>the end</p></article>"
    assert main_text(body, weights) == f"Head\n\nshort intro\n\nTitle\n\n{SECTION.strip()}\n\nthe end"


@pytest.mark.parametrize(
    "part",
    [
        f"<section class='discussion'><div class='comment'><p>{SECTION}</p></div></section>",
        f"<section class='responses'><span class='author'>Ann</span><p>{SECTION}</p></section>",
        f"<section class='feedback'><p>{SECTION}</p><form><input></form></section>",
        f"<section class='related'><p><a href='/'>{SECTION}</a></p></section>",
        f"<section class='discussion'><ol><li><p>{SECTION}</p></li></ol></section>",
        f"<section class='related'><article><p>{SECTION}</p></article></section>",
        f"<section class='comments'><p>{SECTION}</p></section>",
    ],
)
def test_section_of_others_goes_however_long(part):
    assert main_text(f"<article><p>short intro</p>{part}<p>the end</p></article>", {}) == "short intro\n\nthe end"


def test_short_section_of_such_a_name_goes():
    body = f"<article><p>{WORDS}</p><section class='social'><p>follow us there</p></section></article>"
    assert main_text(body, {}) == WORDS.strip()


@pytest.mark.parametrize("weights", [{}, LEARNED])
def test_articles_side_by_side_all_stay(weights):
    one, between, two = (f"{w} " * n for w, n in (("one", 30), ("plain", 50), ("two", 30)))
    body = f"<nav>menu</nav><div><article><p>{one}</p></article><p>{between}</p><article><p>{two}</p></article><p>{between}</p></div>"
    assert main_text(body, weights) == "\n\n".join(t.strip() for t in (one, between, two))


def test_tags_of_no_standard_count_as_one():
    from skyfare.llm.html_text import feature_counts, read_page

    made_up = "".join(f"<x-{i}-with-a-name-of-great-length>word</x-{i}-with-a-name-of-great-length>" for i in range(50))
    found = feature_counts(read_page(f"<article>{made_up}</article>"))
    assert found["in tag other", True] == 100 and {n for n, _ in found} == {f"{w} {x}" for w in ("in", "any") for x in ("tag other", "tag article", "word text")}

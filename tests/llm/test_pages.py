"""Archives and text extraction on pages with known results."""

import hashlib

import pytest

from ledgerlake.llm import archive, html, language

SCHEMA = "page_id long, url string, html string, digest string, path string, text string"
BODY = "<p>" + "x" * 120 + "</p>\r\n\r\nWARC/1.1\r\n"


def test_archive_round_trip(spark):
    rows = [
        (5, "http://a.example/1", BODY),
        (2, "http://a.example/2 b\n", BODY),
        (9, None, BODY),
        (3, "", "short"),
        (4, "u", "short"),
        (6, "u", None),
        (7, "u", ""),
        (8, "u", "é" * 60000),
        (8, "u", "é" * 60000),
        (None, "u", "only here " * 20),
    ]
    pages = spark.createDataFrame([(*r, "d", "p", "t") for r in rows], SCHEMA)
    found = archive.archive_pages(pages).collect()
    assert len(found) == len(rows)
    of = {}
    for r in found:
        of.setdefault(r.page_id, []).append((r.record_type, r.refers_to))
    for page_id, _, text in rows:
        payload = (text or "").encode()
        same = [r for r in found if r.page_id == page_id]
        assert {r.payload_bytes for r in same} == {len(payload)}
        assert {r.payload_digest for r in same} == {hashlib.sha256(payload).hexdigest()}
    assert of[2] == [("response", None)]
    assert of[5] == of[9] == [("revisit", 2)]
    assert all(of[i] == [("response", None)] for i in (3, 4, 6, 7, None))
    assert sorted(of[8], key=str) == [("response", None), ("revisit", 8)]
    assert archive.archive_pages(pages.limit(0)).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions_and_damage(version):
    data = archive.version_block(version) + archive.arc_record(version, 1, "http://a b", "<p>é")
    (record,) = archive.read_arc(data)
    assert record.url == "http://a%20b" and archive.http_parts(record.block)[2] == "<p>é".encode()
    assert archive.iso_date(record.date) == "2026-01-01T00:00:00Z"
    with pytest.raises(ValueError, match="declared"):
        list(archive.read_arc(data[:-3]))
    with pytest.raises(ValueError, match="fields"):
        other = archive.arc_record(3 - version, 1, "u", "x")
        list(archive.read_arc(archive.version_block(version) + other))


PAGE = """<html><head><title>T</title><script>var x = "</p>";</script></head><body>
<header class="top"><h1>Site</h1></header><div id="menu"><a href=x>Home</a> <a>News</a></div>
<div class="cookie-notice">We use cookies. Accept.</div>
<div class="post"><h2>Big news &amp; more</h2>
<p>This is a long  paragraph about something<br>that has happened, with many words in it.</p>
<p>Short.</p><div class="advert">Buy now!</div>
<p>Another paragraph here that is long enough to count as text, I would say.</p></div>
<aside><p>Sidebar text that is long enough to count as text by length.</p></aside>
<form><label>Name</label><input><button>Go</button></form>
<section id="comments"><p>First! I really think this is a very good article.</p></section>
<footer>&copy; x</footer>"""
MAIN = """Big news & more
This is a long paragraph about something that has happened, with many words in it.
Short.
Another paragraph here that is long enough to count as text, I would say."""


def test_main_text(spark):
    article = "<body><nav><a>x</a></nav><article><p>One.<p>Two <b>b</b>.</article><div class=ad>No."
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (None, "u", "<p>a<b"), (4, "u", article)]
    pages = spark.createDataFrame([(*r, "d", "p", "clash") for r in rows], SCHEMA)
    found = {r.page_id: r for r in html.extract(pages).collect()}
    assert found[1].text == MAIN and found[1].n_chars == len(MAIN)
    assert found[2].text == found[3].text == "" and found[3].n_chars == 0
    assert found[4].text == "One.\nTwo b."
    assert None in found
    assert html.extract(pages.limit(0)).count() == 0


LONG = "This is a long paragraph about something that has happened, with many words in it."


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>T</title><body><p>{LONG}</p></body></html>",
        f"<head><meta charset=utf-8><script>x</script><p>{LONG}",
        f"<head><title>T</title><style>p {{}}</style><article><p>{LONG}</article>",
        f"<head><title>T</title>{LONG}",
        f"<head><title>T<body><p>{LONG}",
        f"<head><title>T</title><noscript><img src=x></noscript></body><p>{LONG}",
        f"<body><button>Go<p>{LONG}</p>",
        f"<body><button>Go<p>{LONG}</p><button>No</button>",
        f"<body><svg><path d=x><div><p>{LONG}</div>",
        f"<body><script>'</button>'</script><button>Go<svg><title>i</title></svg><p>{LONG}</p>",
    ],
)
def test_elements_left_open(page):
    assert html.main_text(page) == LONG


def test_closed_unread_elements_stay_unread():
    page = f"<head><title>T</title></head><p>{LONG}</p><button><div>{LONG}</div></button>"
    assert html.main_text(page) == LONG
    assert html.main_text(f"<p>{LONG}</p><script>{LONG}<p>{LONG}") == LONG


@pytest.mark.parametrize(
    "page",
    [
        '<body class="right-sidebar"><article><p>{}</p></article>',
        '<html class="has-comments"><body class="nav-open"><p>{}</p></body></html>',
        '<div class="page right-sidebar"><nav><a>x</a></nav><article><p>{}</p></article></div>',
        '<div id="wrap" class="with-comments"><div class="in"><p>{}</p></div></div>',
        '<body><form id="f"><div><p>{}</p></div><input></form>',
        '<article class="post has-sidebar category-related"><p>{}</p></article><p><a>More</a></p>',
        '<div class="post no-sidebar"><p>{}</p></div><div class="sidebar"><p>Old.</p><p>x</p></div>',
        '<article><section id="discussion"><p>{}</p></section></article><footer>x</footer>',
        '<article><section id="related-work"><p>{}</p></section></article><footer>x</footer>',
        '<p data-id="share">{}</p><nav><p>x</p></nav>',
    ],
)
def test_wording_around_content(page):
    assert html.main_text(page.format(LONG)) == LONG


def test_ids_of_headings_are_addresses():
    head = '<h2 id="share-your-results">Share your results</h2>'
    linked = '<h2><a id="related" href="#r">Related</a></h2>'
    page = f"<article><p>{LONG}</p>{head}<p>{LONG}</p></article><footer>x</footer>"
    assert html.main_text(page) == f"{LONG}\nShare your results\n{LONG}"
    assert html.wording(' id="share-your-results"', "h2") == (0.0, False)
    assert "Related" in html.main_text(f"<article><p>{LONG}</p>{linked}<p>{LONG}</p></article>")


@pytest.mark.parametrize(
    "part",
    [
        '<section id="comments"><p>{}</p></section>',
        '<article class="comment-body"><p>{}</p></article>',
        '<div id="footer" class="content"><p>{}</p></div>',
        '<div class="related-posts"><article class="related"><p>{}</p></article></div>',
        '<div class="widget sidebar-content"><p>{}</p></div>',
    ],
)
def test_wording_of_parts_still_counts(part):
    page = f"<body class='has-sidebar'><article><p>{LONG}</p><p>{LONG}</p></article>{part.format(LONG)}"
    assert html.main_text(page) == f"{LONG}\n{LONG}"


def test_minimum_cut_is_minimal():
    import itertools
    import random

    rnd = random.Random(2)
    for _ in range(80):
        size = rnd.randint(1, 7)
        gains = [rnd.uniform(-3, 3) for _ in range(size)]
        edges = [
            (a, b, rnd.uniform(0, 2))
            for a in range(size) for b in range(a + 1, size) if rnd.random() < 0.5
        ]

        def cost(labels):
            lost = sum(abs(g) for g, keep in zip(gains, labels, strict=True) if keep != (g > 0))
            return lost + sum(c for a, b, c in edges if labels[a] != labels[b])

        best = min(cost(x) for x in itertools.product([True, False], repeat=size))
        assert abs(cost(html.minimum_cut(gains, edges)) - best) < 1e-6


def test_landmark_roles_weigh_like_their_elements():
    body = "<article><p>" + "A long sentence of the article itself, with many words in it. " * 4
    for role in ("complementary", "contentinfo", "search", "banner", "navigation", "form"):
        page = f"<html><body>{body}</p></article><div role='{role}'><p>Text of a part.</p></div>"
        assert "Text of a part" not in html.main_text(page), role
    assert "Text of a part" in html.main_text(f"{body}</p><div role='presentation'><p>Text of a part.")


def test_long_pages_take_little_time():
    import time

    block = "<p>" + "Words of a paragraph that belongs here. " * 6 + "</p><nav><a href=x>Menu</a></nav>"
    start = time.perf_counter()
    text = html.main_text("<html><body><div>" + block * 10_000)
    assert time.perf_counter() - start < 20 and text.count("\n") == 9_999 and "Menu" not in text
    start = time.perf_counter()
    html.main_text("<b>" * 8000 + "</i>" * 8000 + "text")
    assert time.perf_counter() - start < 5


def test_a_page_may_be_named_like_a_version_block(spark):
    rows = [(1, "filedesc://x.arc", "<p>one</p>" * 30), (2, "http://b/", "<p>one</p>" * 30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.record_type for r in archive.archive_pages(pages).collect()}
    assert found == {1: "response", 2: "revisit"}


def test_declared_language_of_markup():
    assert language.declared("<html data-lang='fr'>") is None
    assert language.declared("<!-- <html lang='fr'> --><html class=a lang='de-AT'>") == "de"
    assert language.declared("<meta content='es' http-equiv='Content-Language'>") == "es"
    assert language.declared("<html title='lang=fr' xml:lang=en>") == "en"
    assert language.declared("<script>'<html lang=fr>'</script><html lang=''>") is None

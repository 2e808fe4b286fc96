"""Main text of pages: structure, odd markup, and repetition within a host."""

import re
import tracemalloc
from html import unescape

import numpy as np
import pytest

from tidemark.llm import pages as P

SCHEMA = "page_id long, url string, html string, host string, text string, words int"


def text(html):
    return P.article_of(P.blocks_of(html))


@pytest.mark.parametrize("html, want", [
    ("<article><h1>A&amp;B</h1><p>one\n two<br>three<p><b>x</b>y</article><footer>f</footer>",
     "A&B one two three xy"),
    ("<body><nav>m</nav><main>t<aside>s</aside><div class='comments'><p>c</div> u</main>", "t u"),
    ("<article><script>var t='</p>';</script>a<style>p{}</style><!-- c -->b</article>", "ab"),
    ("<article>a<form><input>f</form><div class=\"cookie-notice\">n</div>z</article>", "a z"),
    ("<article><p class=\"notice\">n<p>k &lt;p&gt; &#233;&eacute;&nbsp;x</article>", "k <p> éé x"),
    ("<article>a<div hidden>h</div><div style='display: none'>i</div>b</article>", "a b"),
    ("<body class='has-sidebar'><div id=content><p>k</div><div id=sidebar>s</div>", "k"),
    ("<main><article>a</article><div>other</div></main>", "a"),
    ("<article><ul><li>a<li>b</ul>c < d<td>e</article>", "a b c < d e"),
    ("<article><p>a <span class='ad'>buy</span> b</p></article>", "a b"),
    ("<article><header><h1>T</h1></header>x<footer>by</footer></article>", "T x"),
    ("<article>a<section class='reader-comments'><article>c</article></section></article>", "a"),
    ("<p>no article</p>", None), ("", None), (None, None)])
def test_marked_articles(html, want):
    assert text(html) == want


LONG = " ".join(f"w{k}" for k in range(40))


@pytest.mark.parametrize("html, want", [
    (f"<main><p>{LONG}</p><article class='card'>a teaser</article></main>", f"{LONG} a teaser"),
    (f"<main><p>{LONG}</p></main><article class='card'>a teaser</article>", LONG),
    (f"<article>a teaser</article><div class='content'><p>{LONG}</div>", LONG),
    (f"<main>{LONG}" + "<div class='story'>one two three four</div>" * 30 + "</main>",
     " ".join([LONG] + ["one two three four"] * 30)),
    (f"<main><h1>Blog</h1><article>{LONG}</article><article>{LONG}</article></main>", f"{LONG} {LONG}"),
    (f"<main>by us<article><p>{LONG}</article></main>", LONG),
    (f"<article><main>{LONG}</main><p>end</article>", f"{LONG} end")])
def test_main_text_beside_article_cards(html, want):
    assert text(html) == want


@pytest.mark.parametrize("html, want", [
    (f"<nav>m n</nav><article class='post sidebar-right'><p>{LONG}</p></article>", LONG),
    (f"<div class='content ad-free'><p>{LONG}</p></div><footer>f</footer>", LONG),
    (f"<article class='comment'><h1>Opinion</h1><p>{LONG}</p></article>", f"Opinion {LONG}"),
    (f"<article><p>short text</p><section class='comments'><p>{LONG}</p></section></article>",
     "short text"),
    (f"<p>{LONG}</p><article class='comment'><p>{LONG}</p></article>", None),
    (f"<div class='sidebar'><p>{LONG}</p></div>", None)])
def test_class_names_do_not_empty_a_page(html, want):
    assert text(html) == want


def test_unclosed_and_long_markup():
    assert text("<article>" + "<div>" * 3000 + "deep" + "<b" * 50_000) is not None
    assert text("<article>a<script>never closed <p>b") == "a"
    assert len(text("<article>" + "<p>word " * 60_000)) == 60_000 * 5 - 1
    assert text("<article a='>' b=\">\">x</article>") == "x"


def page(i, body):
    words = " ".join(f"own{i}x{k}" for k in range(30))
    return f"<html><div>Welcome to our site please read all of our rules first</div>{body}" \
           f"<div><p>{words}</p></div><div>Call us any day of the week between nine and five</div>"


def test_repetition_decides_where_nothing_is_marked(spark):
    rows = [(i, f"http://a.org/{i}", page(i, "")) for i in range(12)]
    rows += [(50, "http://b.org/1", page(0, ""))]  # alone on its host: nothing is repeated
    rows += [(60, "http://c.org/1", page(3, "")), (61, "http://c.org/2", page(3, ""))]  # a copy
    rows += [(70, None, None), (71, "http://d.org", ""), (None, "http://a.org/x", page(99, "")),
             (5, "http://a.org/5", page(5, ""))]
    df = spark.createDataFrame([(*r, "h", "t", 1) for r in rows], SCHEMA)
    got = {(r.page_id, r.url): r for r in P.main_text(df).collect()}
    assert P.main_text(df).count() == len(rows)
    for i in [*range(12), None]:
        own = " ".join(f"own{99 if i is None else i}x{k}" for k in range(30))
        r = got[i, f"http://a.org/{'x' if i is None else i}"]
        assert r.text == own and r.n_chars == len(own)
    assert got[50, "http://b.org/1"].text.startswith("Welcome to our site")
    assert got[60, "http://c.org/1"].text.endswith("nine and five")
    assert got[70, None].text == "" and got[71, "http://d.org"].n_chars == 0


def test_blocks_of_a_host_give_the_same(spark, monkeypatch):
    rows = [(i, f"http://a.org/{i}", page(i, "")) for i in range(12)]
    df = spark.createDataFrame([(*r, "h", "t", 1) for r in rows], SCHEMA)
    one = sorted(map(tuple, P.main_text(df).collect()))
    monkeypatch.setattr(P, "BLOCK_TOKENS", 60)
    assert sorted(map(tuple, P.main_text(df).collect())) == one


NOTICE = "<div class='xq7'><p>Read our best stories of the week every Sunday in your mail</p></div>"


@pytest.mark.parametrize("tokens", [P.BLOCK_TOKENS, 60])
def test_notices_of_no_known_class_leave_the_article(spark, monkeypatch, tokens):
    monkeypatch.setattr(P, "BLOCK_TOKENS", tokens)

    def own(i):
        return " ".join(f"own{i}x{k}" for k in range(30))

    quote = "<p>a passage that four of the articles quote word for word in a block</p>"
    rows = [(i, f"http://a.org/{i}", f"<article><p>{own(i)}</p>{NOTICE}{quote if i < 4 else ''}"
             f"<p>end of {i} and goodbye</p></article>") for i in range(8)]
    rows += [(20 + i, f"http://b.org/{i}", f"<article><p>{own(0)}</p>{NOTICE}<p>no {i}</p></article>")
             for i in range(8)]  # near copies
    rows += [(40 + i, f"http://c.org/{i}", f"<article><p>{own(i)}</p>{NOTICE}</article>")
             for i in (0, 0, 0, 0, 0, 0, 1)]  # two articles, however many copies
    df = spark.createDataFrame([(*r, "h", "t", 1) for r in rows], SCHEMA)
    got = {r.page_id: r.text for r in P.main_text(df).collect()}
    said = unescape(re.sub("<[^>]*>", "", NOTICE))
    for i in range(8):
        cited = " " + re.sub("<[^>]*>", "", quote) if i < 4 else ""
        assert got[i] == f"{own(i)}{cited} end of {i} and goodbye"
        assert got[20 + i] == f"{own(0)} {said} no {i}"
    assert got[40] == f"{own(0)} {said}" and got[41] == f"{own(1)} {said}"


def test_copies_of_a_page_fill_no_block(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK_TOKENS", 200)
    rows = [(i, f"http://a.org/{i}", page(max(i - 300, 0), "")) for i in range(310)]
    df = spark.createDataFrame([(*r, "h", "t", 1) for r in rows], SCHEMA)
    placed = P.placed_streams(P.token_streams(df)).collect()
    assert len(placed) == len({r.page for r in placed}) == 10
    assert {r.blocks for r in placed} == {-(-sum(len(r.tokens) for r in placed) // 200)}


def test_suffix_array_finds_every_repeated_window():
    draw = np.random.default_rng(4)
    words = [[f"w{k}" for k in draw.integers(0, 3, 60)] for _ in range(6)]
    found = P.suffix_array(np.arange(6), [P.hashed(w) for w in words])
    got = set(found.loc[found["first"] != found["last"], "window"])
    held = {}
    for i, w in enumerate(words):
        for k, key in enumerate(P.windows(P.hashed(w)).view(np.int64)):
            held.setdefault(tuple(w[k:k + P.DEPTH]), set()).add((i, key))
    want = {key for at in held.values() if len({i for i, _ in at}) > 1 for _, key in at}
    assert got == want and len({k for at in held.values() for _, k in at}) == len(held)


def test_whole_table(spark, folder):
    df = spark.read.parquet(f"{folder}/pages.parquet")
    rows = df.collect()
    got = {r.page_id: r for r in P.main_text(df).collect()}
    assert len(got) == len(rows)
    for r in rows:
        body = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        body = re.sub(r"</?b>", "", body)
        parts = [" ".join(unescape(x).split()) for x in re.split(r"<[^>]*>", body)]
        want = " ".join(p for p in parts if p)
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)


def test_empty_table(spark):
    assert P.main_text(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_cutting_gives_both_streams_and_parts_lose_no_page(spark, monkeypatch):
    monkeypatch.setattr(P, "PART", 3)
    rows = [(i, f"http://a.org/{i % 2}", f"<nav>menu of {i} with eight words or more than that</nav>"
             f"<article><p>{' '.join(f'own{i}x{k}' for k in range(9))}</p>{NOTICE}</article>")
            for i in range(20)] + [(30, None, None), (31, "http://a.org/", page(3, ""))]
    df = spark.createDataFrame([(*r, "h", "t", 1) for r in rows], SCHEMA).coalesce(1)
    got = P.both_streams(df).collect()
    assert sorted(r.inside for r in got) == [False] * 21 + [True] * 20
    assert all((r.narrow is None) != r.inside and (r.wide is None) == r.inside for r in got)
    one, other = P.token_streams(df, True).collect(), P.token_streams(df).collect()
    assert len(one) == 20 and len(other) == 21
    assert {len(r.tokens) for r in one} == {9 + len(re.sub("<[^>]*>", "", NOTICE).split())}
    assert sorted(r.page_id for r in P.main_text(df).collect()) == [*range(20), 30, 31]


def test_suffix_array_hands_on_what_is_asked_and_takes_little_memory():
    draw = np.random.default_rng(6)
    pages = draw.permutation(50).astype(np.int64) - 9
    streams = [draw.integers(0, 4, 90).astype(np.uint64) for _ in pages]
    every = P.suffix_array(pages, streams)
    held = {}
    for p, s in zip(pages, streams):
        for key in P.windows(s).view(np.int64):
            held.setdefault(key, set()).add(p)
    assert {r.window: (r.first, r.last, r.pages) for r in every.itertuples()} == {
        k: (min(v), max(v), len(v)) for k, v in held.items()}
    few = P.suffix_array(pages, streams, 2)
    assert few.equals(every[every["pages"] >= 2].reset_index(drop=True))
    assert P.suffix_array(pages[:0], []).empty
    large = [draw.integers(0, 1 << 62, 5000).astype(np.uint64) for _ in range(200)]
    tracemalloc.start()
    P.suffix_array(np.arange(200), large, 5)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 55 * 1_000_000  # bytes a token

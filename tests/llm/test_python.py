"""Packing, HTML extraction and nearest neighbours against plain versions."""

from __future__ import annotations

import html
import random
import re
import struct
import sys
import time
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from shelfwise.llm import html_text, nearest, packing  # noqa: E402

TABLES = "/root/testdata/sf0.001"


def given(spark, name):
    return spark.read.parquet(f"{TABLES}/{name}.parquet")


# ---- packing

ODD_TEXTS = [None, "", " \n ", "a", "É x y  don't <|endoftext|> it's Σς İ ﬁ é", "word " * 5000, "z" * 300,
             "same text", "same text", "日本語 テキスト 😀😀", "tab\tvt\x0bff\x0c\x1c\x85end"]


@pytest.mark.parametrize("which", ["given", "odd"])
def test_packing(spark, which):
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    docs = given(spark, "documents") if which == "given" else spark.createDataFrame(
        [(i if i != 7 else None, t, "c", 1) for i, t in enumerate(ODD_TEXTS)],
        "doc_id long, text string, piece string, offset long")
    rows = packing.pack_documents(docs).collect()
    tokenizer = tokenizers.Tokenizer.from_file(public.path("word_bpe_49k.json"))
    expected = []
    for doc in docs.collect():
        ids = tokenizer.encode(doc["text"] or "", add_special_tokens=False).ids + [0]
        for n, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at:at + 2048]
            expected.append((doc["doc_id"] or -1, n, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    found = [(r["doc_id"] or -1, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(found) == sorted(expected)
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    least = -(-sum(e[3] for e in expected) // 2048)
    assert len(places) <= least * 1.1 + 2
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_chunk_ids_are_those_of_whole_texts():
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    tokenizer = tokenizers.Tokenizer.from_file(public.path("word_bpe_49k.json"))
    known = packing.ChunkIds(None)
    pieces = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "<", "|", ">", "word", "Word", "don't", "'s",
              "!!", ",", ".", "12", "é", "ÉA", "日本", " ", "  ", "\n", "\t", "ß", "_", "-", "\x85", "😀", "a", "Z"]
    draw = random.Random(7)
    for _ in range(20_000):
        text = "".join(draw.choice(pieces) for _ in range(draw.randrange(1, 12)))
        expected = struct.pack("<I", 0)
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert known.of(text.encode()) == struct.pack(f"<{len(ids)}I", *ids) + expected, text


def test_packer_takes_the_fullest_that_fits():
    packer = packing.Packer(10, 2)
    assert [packer.place(n) for n in (6, 5, 4, 5, 10, 3, 8, 9)] == [
        (0, 0), (1, 0), (0, 6), (1, 5), (2, 0), (3, 0), (4, 0), (5, 0)]
    # Sequence 4 (2 free) was the fullest of the two open ones and was closed; 3 is still open.
    assert packer.place(7) == (3, 3)


# ---- HTML

CASES = [
    (None, ""), ("", ""), ("just text", "just text"), ("<p>", ""),
    ("<body><nav><a href=x>Menu</a></nav><article><h1>Title &amp; more</h1><p>One, two,\n three.</p><p><b>Bold<br>next"
     "<p>Last&nbsp;one &lt;3</article><footer>foot</footer>", "Title & more One, two, three. Bold next Last one <3"),
    ("<div class='sidebar'><p>Side text, long, with, commas, everywhere, to, win.</p></div><div id=content><p>Main, text"
     "</p><div class=ad>buy</div><p>goes on, here, and here</p></div><div class=comments><p>first!, second, third</p>"
     "</div>", "Main, text goes on, here, and here"),
    ("<article><p>a<script>var x='</p>';</script>b</p><style>p{}</style><!-- <p>no</p> --><p title='a>b'>c</p>"
     "<form><p>no</p></form><aside>no</aside></article>", "ab c"),
    ("<main><ul><li>one<li>two</ul><table><tr><td>x<td>y</table></main>", "one two x y"),
    ("<p>if a < b &copy; d", "if a < b © d"), ("<p>cut off <b", "cut off"), ("<article><p>x</p><!-- open", "x"),
    ("<div><section><p>" + "first part, of it. " * 20 + "</p></section><section><p>" + "second part, too. " * 20
     + "</p></section></div><div><p><a href=x>" + "link " * 50 + "</a></p></div>",
     " ".join(["first part, of it."] * 20 + ["second part, too."] * 20)),
    ("<article>" + "<div>" * 3000 + "<p>deep</p>" + "</div>" * 3000 + "</article>", "deep"),
]


def test_html_cases(spark):
    pages = spark.createDataFrame([(i, None, page, 5) for i, (page, _) in enumerate(CASES * 2)],
                                  "page_id long, url string, html string, text int")
    rows = html_text.extract(pages).collect()
    assert len(rows) == 2 * len(CASES)
    for r in rows:
        wanted = CASES[r["page_id"] % len(CASES)]
        assert r["text"] == wanted[1], wanted[0][:300]
        assert r["n_chars"] == len(wanted[1])
    assert html_text.extract(pages.limit(0)).count() == 0


def test_html_short_parts():
    """Parts of unequal length without an article element all stay; lists of links beside them do not."""
    long = "<p>" + "long, long, long, part " * 17 + "</p>"
    parts = (f"<section>{long * 10}</section><section><p>Short part, one comma.</p></section><ul><li>item</ul>"
             "<blockquote>quote</blockquote><table><tr><td>cell</table>")
    wanted = " ".join(["long, long, long, part"] * 170 + ["Short part, one comma. item quote cell"])
    assert html_text.main_text(f"<main>{parts}</main><div><p>Elsewhere</p></div>") == wanted
    links = "<div><p><a href=x>some link</a> | <a href=y>another link</a></p></div>"
    assert html_text.main_text(f"<body><div>loose {parts}{links}</div></body>") == "loose " + wanted


def test_html_layout_classes():
    """A wrapper whose class has the word of a part to leave out keeps the article; such parts inside it go."""
    body = "<p>" + "body, of text. " * 30 + "</p>"
    inner = f"{body}<div class=sidebar><p>side, by, side</p></div><div class='comments'><p>first!</p></div>"
    wanted = " ".join(["body, of text."] * 30)
    for name in ("layout with-sidebar", "no-comments", "has-banner"):
        for inside in (inner, f"<article>{inner}</article>", f"<main>{inner}</main>"):
            assert html_text.main_text(f"<body><div id='content' class='{name}'>{inside}</div></body>") == wanted
        assert html_text.main_text(f"<main><div class='{name}'>{inner}</div></main>") == wanted
    # Comments that are articles themselves do not win against the article they follow, however long.
    comments = "<div id=comments>" + f"<article><p>{'a, comment ' * 5}</p></article>" * 9 + "</div>"
    assert html_text.main_text(f"<main><article>{body}</article>{comments}</main>") == wanted


def test_given_pages(spark):
    """The given pages have one article each; its blocks are cut out by hand here."""
    pages = {r["page_id"]: r["html"] for r in given(spark, "pages").collect()}
    for r in html_text.extract(given(spark, "pages")).collect():
        article = re.search(r"<article>(.*?)(</article>|\Z)", pages[r["page_id"]], re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split())
                  for b in re.split(r"<p>|</p>|<h1>|</h1>", article.replace("<br>", " "))]
        assert r["text"] == " ".join(b for b in blocks if b)


def test_html_words_in_an_articles_own_names():
    """Names of an article's own parts may hold words of parts to leave out; what looks like such a part goes."""
    body = "<p>" + "body, of text. " * 30 + "</p>"
    text = " ".join(["body, of text."] * 30)
    kept = ["<p class='related-work'>Own paragraph.</p>", "<h2 class='share-price'>Own paragraph.</h2>",
            "<p><span class='notice-period'>Own</span> paragraph.</p>", "<p class=notice>Own paragraph.</p>",
            "<div class='article-header'><h2>Own paragraph.</h2></div>", "<p><b class=banner>Own</b> paragraph.</p>",
            "<section class='legal-history'><p>Own paragraph.</p></section>",
            "<header><div class=top><h2>Own paragraph.</h2></div><p>By someone, today</p></header>"]
    gone = ["<p class=advert>Buy this.</p>", "<p class='cookie-notice'>Cookies!</p>", "<div class=notice>Notice.</div>",
            "<p class='share-this'><a href=x>Share</a> <a href=y>this</a></p>", "<div class='page-header'>Site</div>",
            "<div class='read related'><a href=x>Read this too</a></div>", "<header hidden><h2>Hidden</h2></header>",
            "<div class='ad-slot'><p>Buy, buy, buy.</p></div>", "<header class=ad><p>Not the title</p></header>",
            "<p>" + "<a class=comments href=x>9 comments</a>" + "</p>", "<nav><header><h2>Menu</h2></header></nav>"]
    for name in ("article", "main"):
        for part in kept:
            assert html_text.main_text(f"<{name}>{body}{part}{body}</{name}>") == f"{text} Own paragraph. {text}", part
        for part in gone:
            assert html_text.main_text(f"<{name}>{body}{part}{body}</{name}>") == f"{text} {text}", part
    assert html_text.main_text(f"<body><div>{body}</div><div class=legal>All rights reserved</div></body>") == text
    # The header of the site is not the title of an article.
    assert html_text.main_text(f"<header><h1>Site</h1></header><article>{body}</article>") == text


def test_html_second_article():
    body = "<p>" + "body, of text. " * 30 + "</p>"
    text = " ".join(["body, of text."] * 30)
    teaser = "<article><p><a href=x>Read this as well, please</a></p></article>"
    pages = f"<div><article>{body}{body}</article><article>{body}</article>{teaser}</div>"
    assert html_text.main_text(pages) == " ".join([text] * 3)


@pytest.mark.parametrize("piece", ["<div>a", "<p>a", "<b>a", "<ul><li>a", "<div class=related><a href=x>a", "a</i><div>",
                                   "<table><tr><td>a", "<header><h1 class=ad>a", "<article><p class=notice>a</b>"])
def test_html_time_is_linear(piece):
    """Elements nested in each other or never closed: eight times the page takes about eight times as long."""
    def seconds(n):
        start = time.process_time()
        html_text.main_text("<main>" + piece * n)
        return time.process_time() - start

    seconds(1000)
    small, large = min(seconds(2500) for _ in range(3)), min(seconds(20000) for _ in range(2))
    assert large < 20 * small + 0.2


# ---- nearest neighbours

def brute_nearest(rows, every, k=10):
    ids = np.array([r[0] for r in rows])
    vectors = np.array([r[1] for r in rows], float)
    out = {}
    for i, q in zip(ids, vectors):
        if i % every == 0:
            gaps = np.sqrt(((vectors - q) ** 2).sum(1))
            order = [j for j in np.lexsort((ids, gaps)) if ids[j] != i][:k]
            out[i] = [(ids[j], gaps[j]) for j in order]
    return out


def test_nearest_given(spark):
    table = given(spark, "embeddings")
    index = nearest.Index(table)
    found = index.search(F.col("id") % 100 == 0).collect()
    true = brute_nearest([(r["vec_id"], r["embedding"]) for r in table.collect()], 100)
    got = defaultdict(list)
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert got.keys() == true.keys() and all(len(v) == 10 for v in got.values())
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in true[q]}) for q in true)
    assert hits >= 0.9 * 10 * len(true)
    by_id = {r["vec_id"]: np.array(r["embedding"], float) for r in table.collect()}
    for q, near in got.items():
        assert near == sorted(near, key=lambda x: (x[1], x[0]))
        assert all(s == pytest.approx(np.linalg.norm(by_id[q] - by_id[v]), abs=1e-12) for v, s in near)


def test_nearest_odd_rows_ties_and_cuts(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK_ROWS", 50)
    monkeypatch.setattr(nearest, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(0, 300)] + [(i, rng.normal(size=3).tolist()) for i in range(300, 700)]
    odd = [(900, None), (1000, [0.0, 0.0, 0.0]), (1100, [1.0, None, 2.0]), (1200, [float("nan"), 1.0, 2.0]),
           (1300, [float("inf"), 1.0, 1.0]), (1400, [1.0, 2.0]), (1500, [])]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("id", F.lit("x"))
    found = nearest.Index(table).search(F.col("id") % 100 == 0, k=10).collect()
    true = brute_nearest(rows, 100)
    assert {r["query_id"] for r in found} == set(true)
    for r in found:
        if r["query_id"] < 300:  # the copies: distance 0, smallest ids first
            assert r["score"] == 0.0 and r["vec_id"] == true[r["query_id"]][r["rank"] - 1][0]
    few = spark.createDataFrame(rows[:1] + rows[300:303], "vec_id long, embedding array<double>")
    assert sorted(r["rank"] for r in nearest.Index(few).search(F.col("id") == 0).collect()) == [1, 2, 3]
    assert nearest.Index(few.limit(0)).search(F.col("id") == 0).count() == 0


def test_repeated_queries_have_lists_of_their_own(spark):
    """Two rows with one id are two queries, each with all its neighbours; a twin is a candidate like any other."""
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(1, 200)]
    twins = [(200, rng.normal(size=4).tolist()), (200, rng.normal(size=4).tolist()), (300, rows[0][1]), (300, rows[0][1])]
    table = spark.createDataFrame(rows + twins, "vec_id long, embedding array<double>")
    found = nearest.Index(table).search(F.col("id") % 100 == 0, k=10, depth=1000).collect()
    every = [(i, np.array(v)) for i, v in rows + twins]
    expected = []
    for at, (key, v) in enumerate(every):
        if key % 100 == 0:
            near = sorted((float(np.sqrt(((w - v) ** 2).sum())), i) for j, (i, w) in enumerate(every) if j != at)[:10]
            expected += [(key, rank, i, round(s, 9)) for rank, (s, i) in enumerate(near, 1)]
    assert sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in found) == sorted(expected)


def test_walk_is_in_order():
    rng = np.random.default_rng(1)
    books = nearest.Codebooks(rng.normal(size=(7, 2)), rng.normal(size=(5, 3)))
    query = rng.normal(size=5)
    cells = list(books.walk(query))
    assert sorted(cells) == list(range(35))
    sums = [((books.left[c // 5] - query[:2]) ** 2).sum() + ((books.right[c % 5] - query[2:]) ** 2).sum() for c in cells]
    assert sums == sorted(sums)

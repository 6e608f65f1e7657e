"""Whitening, ranked lexical search and language profiles against plain versions."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import language, lexical, whitening

TABLES = "/root/testdata/sf0.001"


def given(spark, name):
    return spark.read.parquet(f"{TABLES}/{name}.parquet")


# ---- whitening

def plain_whitening(rows, wanted=4):
    """By a full eigendecomposition; the sign of each component is left open."""
    usable = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows]
    fit = sorted({tuple(x) for _, x in usable})
    n, sums = len(fit), [sum(col) for col in zip(*fit)]
    centred = np.array(fit, float) - np.array(sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:wanted], vectors[:, ::-1][:, :wanted]
    out = []
    for i, x in usable:
        white = (np.array(x, float) - np.array(sums) / n) @ vectors / np.sqrt(values)
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        out += [(i, c + 1, n, deviation, white[c], values[c] / (np.trace(centred.T @ centred) / n))
                for c in range(len(values))]
    return out


def check_whitening(found, expected):
    key = lambda r: (r[0], r[1], r[3], r[4])
    signs = {}
    for component in {r["component"] for r in found}:
        ours = {(r["vec_id"], r["deviation"]): r["whitened"] for r in found if r["component"] == component}
        theirs = {(e[0], e[3]): e[4] for e in expected if e[1] == component}
        assert ours.keys() == theirs.keys()
        signs[component] = 1 if sum(ours[k] * theirs[k] for k in ours) > 0 else -1
    mine = sorted(((r["vec_id"], r["component"], r["n"], r["deviation"], r["whitened"] * signs[r["component"]],
                    r["explained"]) for r in found), key=key)
    for a, b in zip(mine, sorted(expected, key=key), strict=True):
        assert a[:4] == b[:4]
        assert a[4] == pytest.approx(b[4], abs=1e-9)
        assert a[5] == pytest.approx(b[5], rel=1e-10)
    assert {r["identity_error"] for r in found} and max(r["identity_error"] for r in found) < 1e-10


def test_whitening_given(spark):
    table = given(spark, "embeddings")
    found = whitening.whiten(table.unionByName(table.filter("vec_id % 3 = 0"))).collect()
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    check_whitening(found, plain_whitening(rows + [r for r in rows if r[0] % 3 == 0]))


def test_whitening_odd_rows(spark):
    draw = np.random.default_rng(5)
    good = [(i, (draw.standard_normal(3) * [3, 1, 9] + 100).tolist(), "x") for i in range(40)]
    good += [(None, good[0][1], "y"), (7, good[7][1], "z")]
    bad = [(100, None, "a"), (101, [1.0, None, 2.0], "a"), (102, [1.0, float("nan"), 2.0], "a"),
           (103, [float("inf"), 0.0, 0.0], "a"), (104, [1.0, 2.0], "a"), (105, [], "a"), (106, [1e300, 0.0, 0.0], "a")]
    table = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>, component string")
    found = whitening.whiten(table).collect()
    assert {r["vec_id"] for r in found} == {i for i, _, _ in good}
    assert len(found) == 3 * len(good)
    check_whitening([r for r in found if r["vec_id"] is not None], plain_whitening([(i, v) for i, v, _ in good if i is not None]))
    assert whitening.whiten(table.limit(0)).collect() == []
    # No variance: no components. A line: one component.
    same = spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert whitening.whiten(same).collect() == []
    line = spark.createDataFrame([(i, [float(i), -0.0, 2.0 * i]) for i in range(9)], "vec_id long, embedding array<float>")
    found = whitening.whiten(line).collect()
    assert {r["component"] for r in found} == {1} and found[0]["explained"] == pytest.approx(1.0)


def test_whitening_needs_the_filter(spark):
    """More dimensions than vectors in the block, values close together: certified, in few passes."""
    draw = np.random.default_rng(2)
    data = draw.standard_normal((600, 90)) * np.linspace(1.3, 1.0, 90) * 4
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
    found = whitening.whiten(table, guard=12).collect()
    check_whitening(found, plain_whitening([(i, v.tolist()) for i, v in enumerate(data)]))
    fit = whitening.fit(whitening.whole_numbers(table, "embedding"), guard=12)
    assert fit.residuals.max() <= whitening.ACCEPTED * fit.values[0]
    assert fit.passes < 300


def test_deviation_of_large_numbers():
    x = np.array([[2**40, -(2**40)], [0, 1], [5, 2**62]])
    sums = tuple(int(s) for s in x.sum(axis=0))
    expected = [sum((3 * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    assert whitening._deviations(x, 3, sums) == [v if v < 2**63 else None for v in expected]
    assert whitening._deviations(np.array([[3, 4]]), 2, (1, 1)) == [25 + 49]


# ---- lexical search

def plain_search(docs, items, k):
    terms = [Counter(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub(
        "[A-Z]", lambda m: m[0].lower(), t or ""))) for _, t in docs]
    n_docs, n_terms = sum(bool(t) for t in terms), sum(sum(t.values()) for t in terms)
    df = Counter(w for t in terms for w in t)
    out = []
    for item, text in items:
        words = set(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub(
            "[A-Z]", lambda m: m[0].lower(), text or "")))
        scored = []
        for (doc, _), counts in zip(docs, terms):
            m = 50 + 50 * sum(counts.values()) * n_docs // n_terms if n_terms else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                        * (1000000000 * counts[w] // (1000 * counts[w] + 20 * m)) for w in words if w in counts)
            if score:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, at, line[3], -line[0]) for at, line in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("bucket, head, block", [(2048, 16384, 200_000), (16, 20, 150), (7, 1, 1)])
def test_search_given(spark, monkeypatch, bucket, head, block):
    """Small buckets and a small head let every bound take part; small blocks part the queries."""
    monkeypatch.setattr(lexical, "BUCKET_ROWS", bucket)
    monkeypatch.setattr(lexical, "HEAD_ROWS", head)
    docs, items = given(spark, "documents"), given(spark, "benchmark")
    if block == 1:
        items = items.filter("item_id < 3")
    found = lexical.search(docs, items, k=7, block_terms=block).collect()
    expected = plain_search([(r["doc_id"], r["text"]) for r in docs.collect()],
                            [(r["item_id"], r["text"]) for r in items.collect()], 7)
    assert sorted((tuple(r) for r in found), key=repr) == expected


def test_bounds_leave_out_work():
    """A bucket whose longest vector is too short ends the search; inside, only documents within reach are scored."""
    import pyarrow as pa

    weights = np.array([4, 1, 9], np.int64)
    ids, impacts = [[0, 1, 2], [0, 1], [1]], [[10, 10, 10], [10, 10], [10]]
    length = [math.sqrt(sum(weights[i] * v * v for i, v in zip(a, b))) for a, b in zip(ids, impacts)]
    batch = pa.record_batch([pa.array([1, 2, 3]), pa.array(length), pa.array(ids, pa.list_(pa.int32())),
                             pa.array(impacts, pa.list_(pa.int32()))], ["doc_id", "length", "ids", "impacts"])
    bucket, query = lexical.Bucket(batch, weights), lexical.Query(0, np.array([0, 1]), 0)
    assert [a.tolist() for a in bucket.search(query, weights, 0)] == [[0, 1, 2], [50, 50, 10]]
    assert [a.tolist() for a in bucket.search(query, weights, 50)] == [[0, 1], [50, 50]]
    assert [a.tolist() for a in bucket.search(query, weights, 51)] == [[], []]
    assert bucket.search(query, weights, 1000) is None


def test_search_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BUCKET_ROWS", 4)
    long_text = "Alpha beta-Gamma " * 400_000
    docs = [(1, "alpha beta"), (1, "alpha beta"), (None, "alpha beta"), (None, None), (3, ""), (4, "!! ?"), (5, "ÉÀ Alpha é 7"),
            (6, long_text), (7, "gamma\x00delta"), (8, "ALPHA beta")]
    items = [(1, "Alpha beta"), (1, "Alpha beta"), (None, "é delta gamma ÉÀ"), (2, None), (3, "..."), (4, "unknown")]
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, score int")
    asked = spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, doc_id int")
    found = lexical.search(frame, asked, k=4).collect()
    assert sorted((tuple(r) for r in found), key=repr) == plain_search(docs, items, 4)
    assert lexical.search(frame.limit(0), asked).collect() == []
    assert lexical.search(frame, asked.limit(0)).collect() == []
    texts = frame.withColumn("doc_id", F.format_string("d%s", "doc_id"))
    assert [r["doc_id"] for r in lexical.search(texts, asked.filter("item_id = 1").limit(1), k=2).orderBy("rank").collect()] \
        == ["d6", "d1"]


def test_terms_of_a_long_text_in_pieces(monkeypatch):
    text = ("Wort für Wort, " * 50).encode() + "ß".encode() * 90
    whole = lexical.term_counts(text)
    monkeypatch.setattr(lexical, "PIECE", 11)
    assert lexical.term_counts(text) == whole
    assert lexical.term_counts(None) == lexical.term_counts(b"") == Counter()


# ---- language

def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{TABLES.replace('sf0.001', 'sf0.01')}/documents.parquet")
    docs = docs.withColumn("held_out", language.split_by_id(docs))
    rows = language.identify(docs, ~F.col("held_out")).filter("held_out").collect()
    assert len(rows) > 150
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_reads_the_text_only(spark):
    docs = given(spark, "documents").select("doc_id", "text", "lang").withColumn("held_out", F.col("doc_id") % 2 == 0)
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs, ~F.col("held_out")).collect()}
    moved = docs.withColumn("lang", F.when(F.col("held_out"), F.lit("xx")).otherwise(F.col("lang")))
    assert {r["doc_id"]: r["lang_pred"] for r in language.identify(moved, ~F.col("held_out")).collect()} == found


def test_language_odd_rows(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (None, "the dog", None), (3, None, "en"),
            (4, "", "en"), (5, "12 ² ___ !", "fr"), (6, "²the²", None), (7, "the cat and the dog", "en"),
            (8, "the dog and the cat " * 100_000, None), (9, "日本語", None)]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, score double")
    found = language.identify(docs, F.col("lang").isNotNull()).collect()
    assert sorted(found[0].asDict()) == ["doc_id", "lang", "lang_pred", "score"]
    by_id = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in found}
    assert by_id[None][0] == by_id[1][0] == by_id[6][0] == by_id[7][0] == by_id[8][0] == "en"
    assert by_id[2] == ("fr", 1.0)
    assert by_id[3] == by_id[4] == by_id[5] == ("und", 0.0)
    assert by_id[9] == ("en", 0.0)  # no profile has any of its n-grams: the first name
    nothing = language.identify(docs, F.lit(False)).collect()
    assert {(r["lang_pred"], r["score"]) for r in nothing} == {("und", 0.0)}
    assert language.identify(docs.limit(0), F.lit(True)).collect() == []
    split = docs.select("doc_id", language.split_by_id(docs).alias("held_out")).collect()
    import zlib
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in split)


def plain_grams(text):
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    found = Counter()
    for w in words:
        p = f" {w} "
        found.update(p[i:i + n] for n in (1, 2, 3) for i in range(len(p) - n + 1) if p[i:i + n] != " ")
    return {sum(ord(c) << (21 * (2 - i)) for i, c in enumerate(g)): n for g, n in found.items()}


@pytest.mark.parametrize("piece", [1, 2, 5, 9, 1 << 20])
def test_grams_in_pieces(monkeypatch, piece):
    monkeypatch.setattr(language, "PIECE", piece)
    for text in (None, "", " ", "a", "a b", "12 ² _!", "Ça va  bien.\n" * 7 + "x" * 30 + " Σίσυφος ²a² 日本語😀 İ"):
        grams, counts = language.gram_counts(text)
        assert dict(zip(grams.tolist(), counts.tolist())) == plain_grams(text)
        assert (np.diff(grams) > 0).all()


def test_too_many_labels(spark, monkeypatch):
    monkeypatch.setattr(language, "MAX_LANGUAGES", 2)
    docs = spark.createDataFrame([(i, "some text", f"l{i}") for i in range(4)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="labels"):
        language.identify(docs, F.lit(True))

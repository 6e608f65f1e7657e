"""N-gram Jaccard join, components and substring dedup against plain versions."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402
from shelfwise.llm import near, substrings  # noqa: E402
from shelfwise.llm.components import components  # noqa: E402

TABLES = "/root/testdata/sf0.001"


def given(spark, name):
    return spark.read.parquet(f"{TABLES}/{name}.parquet")


def families(seed):
    """Groups of near copies with few and many edits, chains, shared passages and small sets."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["The", "of", "AND"]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    texts: list[str | None] = [None, "", "  \n", "a", "A", "a b", "a  B", "a b c", "é È", "é è"]
    for size, copies in ((40, 30), (120, 40), (300, 30)):
        base = prose(size)
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.choice((0, 1, 1, 2, 3, 4, 6, 8))):
                at = rng.randrange(len(words))
                if rng.random() < 0.3:
                    del words[at]
                else:
                    words[at] = rng.choice(vocabulary)
            texts.append(" ".join(words))
        chain = list(base)
        for _ in range(25):
            chain[rng.randrange(len(chain))] = rng.choice(vocabulary)
            texts.append("\t".join(chain))
    passage = prose(60)
    texts += [" ".join(prose(rng.randrange(5, 60)) + passage) for _ in range(30)]
    for n in range(1, 14):
        few = prose(n + 2)
        texts += [" ".join(few), " ".join(few + prose(1)), " ".join(few)]
    return texts


@pytest.mark.parametrize("k, percent, share", [(3, 90, 2), (5, 80, 4)])
def test_near_components(spark, k, percent, share):
    texts = families(k)
    ids = list(range(1000, 1000 + 7 * len(texts), 7))
    random.Random(1).shuffle(ids)
    docs = spark.createDataFrame([(i, t, 1, "y") for i, t in zip(ids, texts)],
                                 "doc_id long, text string, n int, component_id string")
    found = near.near_components(docs, k, percent, share).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute.near_components(
        ids, texts, k, percent)
    kept = sorted(r["doc_id"] for r in near.keep_one(docs, k, percent, share).collect())
    assert kept == sorted({c for _, c in brute.near_components(ids, texts, k, percent).values()})


def test_near_given(spark):
    docs = given(spark, "documents")
    rows = docs.collect()
    found = near.near_components(docs, 3, 90).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute.near_components(
        [r["doc_id"] for r in rows], [r["text"] for r in rows], 3, 90)


def test_near_odd_ids(spark):
    rows = [(None, "a b c d"), (None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (6, None), (None, None), (5, "x y z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(near.near_components(docs, 3, 90).collect(), key=str)
    assert [(r["doc_id"], r["component_id"]) for r in found if r["n_shingles"] == 2] == [
        (5, 5), (5, 5), (None, 5), (None, 5)]
    assert len(found) == len(rows)
    assert near.near_components(docs.limit(0), 3, 90).count() == 0


def test_keep_one_row(spark):
    """One row of each group: repeated rows, near copies without an id, an id with two texts, rows without words."""
    base = [f"w{i}" for i in range(60)]
    near_copy, far = base[:-1] + ["other"], [f"x{i}" for i in range(60)]
    a, b, c, d = " ".join(base), " ".join(near_copy), " ".join(far), " ".join(f"y{i}" for i in range(60))
    rows = ([(3, a, "r")] * 3 + [(3, b, "s"), (9, a, "t"), (None, b, "u")]     # a family: one row of id 3
            + [(None, c, "v")] * 4 + [(None, c + " end", "v")] * 2             # a family without ids
            + [(3, d, "w"), (2, d + " end", "x")]                              # id 3 again, its group's id is 2
            + [(4, None, "y"), (4, None, "y"), (None, "", "z"), (None, " ", "z")])
    docs = spark.createDataFrame(rows, "doc_id int, text string, copies string").repartition(5)
    kept = near.keep_one(docs)
    assert kept.schema.simpleString() == docs.schema.simpleString()
    found = [tuple(r) for r in kept.collect()]
    assert all(r in rows for r in found)
    worded = [r for r in found if (r[1] or "").strip()]
    assert sorted((str(r[0]), r[1][:2]) for r in worded) == [("2", "y0"), ("3", "w0"), ("None", "x0")]
    assert sorted(map(str, set(found) - set(worded))) == sorted(map(str, set(rows[-4:])))
    assert len(found) == 3 + 4
    assert near.keep_one(docs.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(100, 180)] + [(500, i) for i in range(501, 560)] + [
        (rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)] + [(7, 7)]
    found = {r["v"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = brute.components(1200, links)
    assert found == {v: expected[v] for a, b in links if a != b for v in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def check_repeats(rows, texts, length):
    expected = brute.repeats(texts, length)
    for r in rows:
        words, gone = expected[r["doc_id"]]
        assert (r["n_words"], r["n_removed"]) == (len(words), len(gone)), r["doc_id"]
        assert r["kept"] == " ".join(w for i, w in enumerate(words) if i not in gone)
        assert {i for s in r["spans"] for i in range(s["start"], s["end"])} == gone
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))


@pytest.mark.parametrize("length", [35, 12])
def test_repeats(spark, length):
    """Passages at all places of texts, in copies, within one text, overlapping, and next to each other."""
    rng = random.Random(length)
    vocabulary = [f"w{i}" for i in range(400)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passages = [prose(n) for n in (length - 1, length, length + 1, 50, 60, 130)]
    texts = [None, "", " ", "one", " ".join(prose(length - 1)), "x " * 200, "x " * (length + 1), "y " * length]
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            parts += prose(rng.choice((0, 3, 20, 80))) + rng.choice(passages)[rng.choice((0, 0, 5)):]
        texts.append("\n".join(parts))
    base = prose(200)
    for _ in range(30):
        words = list(base)
        for _ in range(rng.randrange(0, 6)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts.append("  ".join(words))
    texts += texts[-3:] + [" ".join(prose(100))] * 2 + [" ".join(passages[5]), " ".join(passages[5])]
    docs = spark.createDataFrame([(i, t, 1, "s") for i, t in enumerate(texts)],
                                 "doc_id long, text string, pos int, spans string")
    check_repeats(substrings.remove_repeats(docs, length).collect(), texts, length)


def test_repeats_given(spark):
    rows = sorted(given(spark, "documents").collect(), key=lambda r: r["doc_id"])
    assert [r["doc_id"] for r in rows] == list(range(len(rows)))
    check_repeats(substrings.remove_repeats(given(spark, "documents")).collect(), [r["text"] for r in rows], 35)


def test_repeats_odd_rows(spark):
    rows = [(None, "a b"), (None, "a b"), (3, "q " * 40), (3, "q " * 40), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r["n_words"], r["n_removed"]) for r in substrings.remove_repeats(docs).collect())
    assert found == [(0, 0), (2, 0), (2, 0), (40, 40), (40, 40)]
    assert substrings.remove_repeats(docs.limit(0)).count() == 0

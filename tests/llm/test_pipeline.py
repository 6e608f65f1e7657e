"""The pipeline's stages against plain Python, each on its own input."""

from __future__ import annotations

import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The input of each stage and the last result, written and read again."""
    place = tmp_path_factory.mktemp("steps")
    frames = [spark.read.parquet(f"{TABLES}/documents.parquet")]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frames[-1], TABLES).write.parquet(f"{place}/{i}")
        frames.append(spark.read.parquet(f"{place}/{i}"))
    return frames


def by_id(frame):
    return {r["doc_id"]: r for r in frame.collect()}


def test_columns(steps):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(f.schema.simpleString() == steps[0].schema.simpleString() for f in steps[1:-1])


def test_quality_stage(steps):
    before, after = by_id(steps[0]), by_id(steps[1])
    for doc_id, row in before.items():
        if brute.quality(row["text"])["base_failed"]:
            assert doc_id not in after
    assert all(after[i] == before[i] for i in after)
    labels = {r["doc_id"]: r["quality"] for r in
              steps[0].sparkSession.read.parquet(f"{TABLES}/labels.parquet").collect()}
    good = [i for i, q in labels.items() if q == 1 and not brute.quality(before[i]["text"])["base_failed"]]
    assert good and all(i in after for i in good)


def test_near_stage(steps):
    before, after = by_id(steps[1]), by_id(steps[2])
    found = brute.near_components(list(before), [r["text"] for r in before.values()], 5, 80)
    assert set(after) == {c for _, c in found.values()} and all(after[i] == before[i] for i in after)


def test_secret_stage(steps):
    before, after = by_id(steps[2]), by_id(steps[3])
    assert set(before) == set(after)
    for doc_id, row in after.items():
        spans = [s.split(":") for s in brute.secrets(before[doc_id]["text"])]
        assert not any(before[doc_id]["text"][int(s):int(e)] in row["text"] for _, s, e in spans)
        assert row["n_chars"] == len(row["text"])
        if "[SECRET]" not in row["text"]:
            assert row["text"] == before[doc_id]["text"]


def test_mix_stage(steps):
    before, after = by_id(steps[3]), Counter(r["doc_id"] for r in steps[4].collect())
    assert set(after) <= set(before) and max(after.values()) <= 3
    words = {i: len(brute.words(r["text"])) for i, r in before.items()}
    sizes, taken = Counter(), Counter()
    for i, r in before.items():
        sizes[r["source"]] += words[i]
        taken[r["source"]] += words[i] * after[i]
    for source, target in brute.targets(sizes).items():
        assert abs(taken[source] - target) <= 2 * max(words.values())


def test_pack_stage(steps):
    copies, rows = Counter(r["doc_id"] for r in steps[4].collect()), steps[5].collect()
    assert Counter(r["doc_id"] for r in rows if r["piece"] == 0) == copies
    used = Counter()
    for r in rows:
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 2048 and len(used) <= 1.1 * sum(used.values()) / 2048 + 2


def test_empty_and_odd_tables(spark, tmp_path):
    schema = spark.read.parquet(f"{TABLES}/documents.parquet").schema
    odd = [(None, None, None, None, None), (1, "", None, "a", 0), (2, None, "en", None, None)] + [
        (i % 5, " ".join(f"w{(i % 7) * 40 + j}" for j in range(40)), "en", ("a", "b", None)[i % 3], 1) for i in range(30)]
    for name, rows in (("empty", []), ("odd", odd)):
        (tmp_path / name).mkdir()
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        found = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert bool(found) == bool(rows)


def test_clashing_columns(spark):
    """Extra columns with the names that the operators use come through every stage but the last unchanged."""
    names = ["base", "spans", "failed", "n_words", "size", "hash", "v", "n", "sample", "th", "copies", "taken", "piece"]
    text = " ".join(f"w{j}" for j in range(40)) + " token = abcdef0123456789abcdef01"
    docs = spark.createDataFrame([(1, text, "en", "a", 9, *names), (2, text, "en", "b", 9, *names)],
                                 "doc_id long, text string, lang string, source string, n_chars long, "
                                 + ", ".join(f"{n} string" for n in names))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, TABLES)
        rows = docs.collect()
        assert rows and all([r[n] for n in names] == names for r in rows)
    assert "[SECRET]" in rows[0]["text"] and corpus_pipeline.STAGES[-1][1](spark, docs, TABLES).count() == len(rows)

"""Ranked lexical search over impact vectors, with norm buckets.

A document is a vector of impacts, one whole number for each term of the queries it holds; a query is a vector of term
weights; the score is their product. Vectors are ordered by length over the whole table (range-partitioned) and cut
into buckets. For a query and a bucket:

* Cauchy-Schwarz: when the query's length times that of the bucket's longest vector is below the query's threshold, the
  bucket and all after it in the task are left out; within a bucket the same bound cuts off the shorter vectors.
* Coordinate bounds: terms are taken by the most they can add in this bucket. Once all the others together cannot reach
  the threshold, documents with none of the terms so far are out; of the rest those stay whose product so far plus
  the bound on what is left (by coordinates, and by the lengths that are left) reaches it.
* Survivors are rescored exactly in 64-bit whole numbers and kept in the task's best list.

The threshold is the score of the last place of the best list so far, and starts from that over about ``HEAD_ROWS`` of
the longest vectors, so it never exceeds the true one: results are exact, ties included. Each task sends at most ``k`` rows
a query.

Queries come in blocks with ``BLOCK_TERMS`` terms in all (one query more at most), each block one search over all
documents; only one block's terms, their counts and thresholds are on the driver and broadcast.

Defined cases: null or empty texts have no terms, find nothing and are found by nothing; very long texts are counted in
pieces, whole; equal scores rank by id, null last, and repeated rows take a place each; repeated queries (also with one
id) are searched each by itself; empty tables give no rows; further columns of any name are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from shelfwise.llm import ship
from shelfwise.llm.common import shuffle_partitions, sums_before
from shelfwise.operators.materialise import settle

ship(__name__)

BEST = 50
BLOCK_TERMS = 200_000
HEAD_ROWS = 16_384
BUCKET_ROWS = 2048
PIECE = 1 << 22
# Lengths are doubles, so bounds made of them are widened by far more than their rounding.
WIDER = 1 + 1e-9
# Bytes that belong to terms: digits, letters (in lower case) and all that is not ASCII.
_KEPT = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()
VECTORS = "n long, ids array<int>, counts array<int>"
IMPACTS = "length double, ids array<int>, impacts array<int>"


def term_counts(text: bytes | None) -> Counter:
    """How often each term occurs in a text."""
    found: Counter = Counter()
    text, at = text or b"", 0
    while at < len(text):
        end = min(at + PIECE, len(text))
        while end < len(text) and _KEPT[text[end]] != 32:
            end += 1
        found.update(text[at:end].translate(_KEPT).split())
        at = end
    return found


def _distinct_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.record_batch([batch.column("item_id"), pa.array(
            [sorted(term_counts(t.as_py())) for t in batch.column("__text")], pa.list_(pa.binary()))], ["item_id", "terms"])


def _counted(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            sizes, ids, counts = [], [], []
            for text in batch.column("__text"):
                found = term_counts(text.as_py())
                own = sorted((known[t], found[t]) for t in found.keys() & known.keys())
                sizes.append(sum(found.values()))
                ids.append([i for i, _ in own])
                counts.append([n for _, n in own])
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids, pa.list_(pa.int32())),
                 pa.array(counts, pa.list_(pa.int32()))], ["doc_id", "n", "ids", "counts"])

    return run


def _bounds(lists: pa.ListArray) -> np.ndarray:
    """Where each list begins and the last ends, counted from the first."""
    at = lists.offsets.to_numpy().astype(np.int64)
    return at - at[0]


def _impacts(weights, n_docs: int, n_terms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for batch in batches:
            at = _bounds(batch.column("ids"))
            ids = batch.column("ids").flatten().to_numpy()
            tf = batch.column("counts").flatten().to_numpy().astype(np.int64)
            # Python's numbers, as n times N may exceed a long.
            m = np.array([50 + 50 * n * n_docs // n_terms for n in batch.column("n").to_pylist()], np.int64)
            row = np.repeat(np.arange(len(m)), np.diff(at))
            impact = (1_000_000_000 * tf) // (1000 * tf + 20 * m[row])
            square = np.bincount(row, w[ids] * impact.astype(float) ** 2, minlength=len(m))
            offsets = pa.array(at, pa.int32())
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(np.sqrt(square)), pa.ListArray.from_arrays(offsets, pa.array(ids)),
                 pa.ListArray.from_arrays(offsets, pa.array(impact.astype(np.int32)))],
                ["doc_id", "length", "ids", "impacts"])

    return run


@dataclass
class Query:
    key: int
    terms: np.ndarray
    floor: int  # the score that a result needs at least


class Bucket:
    """Vectors of falling length, with the documents of each term."""

    def __init__(self, batch: pa.RecordBatch, weights: np.ndarray):
        self.docs = batch.column("doc_id")
        self.length = batch.column("length").to_numpy()
        at = _bounds(batch.column("ids"))
        ids = batch.column("ids").flatten().to_numpy()
        impact = batch.column("impacts").flatten().to_numpy().astype(np.int64)
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        self.row = np.repeat(np.arange(len(self.length)), np.diff(at))[order]
        w = weights[ids]
        self.adds = w * impact[order]
        self.square = self.adds * impact[order].astype(float)
        self.at = np.searchsorted(ids, np.arange(len(weights) + 1))
        self.most = np.zeros(len(weights), np.int64)
        held = np.flatnonzero(np.diff(self.at))
        if len(held):
            self.most[held] = np.maximum.reduceat(self.adds, self.at[held])

    def search(self, query: Query, weights: np.ndarray, floor: int) -> tuple[np.ndarray, np.ndarray] | None:
        """Rows and exact scores of all documents whose score is above 0 and at least ``floor``; None when no shorter
        vector can have such a score either."""
        w = weights[query.terms]
        reach = math.sqrt(float(w.sum())) * WIDER
        if reach * self.length[0] < floor:
            return None
        within = int(np.searchsorted(-self.length, -floor / reach, side="right")) if reach else 0
        terms = query.terms[np.argsort(-self.most[query.terms], kind="stable")]
        terms = terms[self.most[terms] > 0]
        # What the terms from each place on can add at most.
        rest = np.append(np.cumsum(self.most[terms][::-1])[::-1], 0)
        if not len(terms) or rest[0] < floor:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        needed = int(np.sum(rest[:-1] >= max(floor, 1)))
        score, square = np.zeros(len(self.length), np.int64), np.zeros(len(self.length))
        for t in terms[:needed]:
            part = slice(self.at[t], self.at[t + 1])
            score[self.row[part]] += self.adds[part]
            square[self.row[part]] += self.square[part]
        rows = np.flatnonzero(score[:within])
        left = terms[needed:]
        if len(left) and len(rows):
            longest = np.sqrt(np.maximum(self.length[rows] ** 2 * WIDER - square[rows], 0) * float(weights[left].sum()))
            rows = rows[score[rows] + np.minimum(longest * WIDER, rest[needed]) >= floor]
            for t in left:
                listed = self.row[self.at[t]:self.at[t + 1]]
                place = np.minimum(np.searchsorted(listed, rows), len(listed) - 1)
                hit = listed[place] == rows
                score[rows[hit]] += self.adds[self.at[t]:self.at[t + 1]][place[hit]]
        rows = rows[score[rows] >= floor]
        return rows, score[rows]


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in buckets of even size, whatever the batches."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, BUCKET_ROWS - size)
            held.append(part)
            size += part.num_rows
            at += part.num_rows
            if size == BUCKET_ROWS:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _search(queries, weights, k: int, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, open_queries = weights.value, [Query(*line) for line in queries.value]
        floor = {q.key: q.floor for q in open_queries}
        best: dict[int, list] = {q.key: [] for q in open_queries}
        for batch in _buckets(batches):
            bucket, still = Bucket(batch, w), []
            for query in open_queries:
                found = bucket.search(query, w, floor[query.key])
                if found is None:
                    continue
                still.append(query)
                rows, scores = found
                if len(rows) > k:
                    good = scores >= np.partition(scores, -k)[-k]
                    rows, scores = rows[good], scores[good]
                if len(rows):
                    new = [(-s, d is None, 0 if d is None else d)
                           for s, d in zip(scores.tolist(), bucket.docs.take(pa.array(rows)).to_pylist())]
                    best[query.key] = heapq.nsmallest(k, best[query.key] + new)
                    if len(best[query.key]) == k:
                        floor[query.key] = max(floor[query.key], -best[query.key][-1][0])
            open_queries = still
            if not open_queries:
                break
        for key, lines in best.items():
            if lines:
                yield pa.record_batch(
                    [pa.array([key] * len(lines), pa.int64()), pa.array([None if none else d for _, none, d in lines], kind),
                     pa.array([-s for s, _, _ in lines], pa.int64())], ["__item", "doc_id", "score"])

    return run


def _of_block(docs: DataFrame, lines: list, k: int) -> DataFrame:
    """__item, doc_id and score of the best documents of each task, for one block of queries."""
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    number = {t: i for i, t in enumerate(sorted({bytes(t) for line in lines for t in line["terms"]}))}
    kind = docs.schema["doc_id"].dataType.simpleString()
    vectors = settle(docs.mapInArrow(_counted(share(number)), f"doc_id {kind}, {VECTORS}"), "vectors")
    total = vectors.frame.agg(F.sum((F.col("n") > 0).cast("long")).alias("docs"), F.sum("n").alias("terms"),
                              F.sum((F.size("ids") > 0).cast("long")).alias("vectors")).first()
    n_docs, n_terms = total["docs"] or 0, total["terms"] or 0
    df = np.zeros(len(number), np.int64)
    for line in vectors.frame.select(F.explode("ids").alias("id")).groupBy("id").count().collect():
        df[line["id"]] = line["count"]
    weights = share(np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(f) + 1))) for f in df], np.int64))
    # The salt spreads equal vectors, such as copies, over the ranges.
    impacts = (vectors.frame.filter("size(ids) > 0").mapInArrow(_impacts(weights, n_docs, n_terms), f"doc_id {kind}, {IMPACTS}")
               .withColumn("__salt", F.xxhash64("doc_id", F.monotonically_increasing_id())))
    queries = [(line["__item"], np.array(sorted(number[bytes(t)] for t in line["terms"]), np.int64), 0) for line in lines]
    found_kind = to_arrow_type(docs.schema["doc_id"].dataType)
    schema = f"__item long, doc_id {kind}, score long"
    order = [F.desc("length"), F.col("__salt")]
    # About the longest vectors, where they lie: any set of documents gives a threshold that is not too high.
    share_of_head = HEAD_ROWS / max(total["vectors"] or 0, HEAD_ROWS)
    least = impacts.agg(F.percentile_approx("length", F.lit(1 - share_of_head)).alias("length")).first()["length"] or 0.0
    head = impacts.filter(F.col("length") >= least).drop("__salt").sortWithinPartitions(F.desc("length")).mapInArrow(
        _search(share(queries), weights, k, found_kind), schema)
    last = F.row_number().over(Window.partitionBy("__item").orderBy(F.desc("score")))
    floors = {line["__item"]: line["score"] for line in
              head.withColumn("__at", last).filter(F.col("__at") <= k).filter(F.col("__at") == k).collect()}
    queries = [(key, own, floors.get(key, 0)) for key, own, _ in queries]
    parts = shuffle_partitions(spark)
    ordered = impacts.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("__salt")
    found = settle(ordered.mapInArrow(_search(share(queries), weights, k, found_kind), schema), "found").frame
    vectors.delete()
    return found


def search(docs: DataFrame, items: DataFrame, k: int = BEST, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best rows of ``docs`` (doc_id, text) for each row of ``items``
    (item_id, text)."""
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    terms = settle(items.select("item_id", F.col("text").cast("binary").alias("__text"))
                   .mapInArrow(_distinct_terms, f"item_id {kind}, terms array<binary>").filter("size(terms) > 0"), "items").frame
    keyed = sums_before(terms.select(F.monotonically_increasing_id().alias("__item"), "*", F.size("terms").alias("__n")),
                        ["__item"], "__n", "__before")
    keyed = settle(keyed.withColumn("__block", F.floor(F.col("__before") / block_terms)), "items").frame
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("__text"))
    found = None
    for line in keyed.groupBy("__block").count().orderBy("__block").toLocalIterator():
        lines = keyed.filter(F.col("__block") == line["__block"]).select("__item", "terms").collect()
        part = _of_block(texts, lines, k)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score long")
    place = Window.partitionBy("__item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    names = settle(keyed.select("__item", "item_id"), "names")
    side = F.broadcast(names.frame) if names.fits() else names.frame
    return ranked.join(side, "__item").select("item_id", "rank", "doc_id", "score")

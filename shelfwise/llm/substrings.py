"""Substring dedup by seed and extend: removes words that lie in passages found elsewhere too.

A window is ``length`` consecutive words of one text. Words of windows whose word sequence also starts anywhere else
(in another text or the same one) are removed; windows are judged on the input.

1. Seeds: in every window the smallest hash of its runs of ``GRAM`` words is an anchor, so equal windows have the same
   anchor at the same place. Each text gives its few anchors, with a hash of the words around each (all that windows
   with this anchor can reach).
2. Anchors are joined by their hash. One that occurs once has no repeat. One whose surroundings also occur elsewhere
   is extended both ways at once: all its windows are repeats.
3. The other occurrences lie at the edges of repeats. They, and one occurrence of each kind of equal surroundings, are
   extended word by word: the windows in which the anchor is the smallest are hashed and met by hash. Work is linear in
   the occurrences; no pairs are listed, so a passage in a third of all texts costs no more than its own length.
4. Overlapping windows are merged to maximal repeats, and their words removed.

Whole copies of a text are known by its hash: all their windows repeat, whatever the anchors say.

Texts are told apart by 128 bits of hash, windows by 128 (anchor and window). Defined cases: null and empty texts have
no words; texts shorter than a window lose nothing; repeated rows are copies of each other; null ids are kept; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import ship
from shelfwise.llm.common import LOOKUP
from shelfwise.llm.wordhash import Hasher, Words, groups, mixed
from shelfwise.operators.joins import attach
from shelfwise.operators.materialise import settle

ship(__name__)

LENGTH = 35
GRAM = 8
KEYS = ["th1", "th2"]
KEY_TYPES = "th1 long, th2 long"


def _smallest(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` numbers, the place of its smallest one (the first, if several)."""
    best, reach = np.arange(len(hashes)), 1
    while reach < width:
        step = min(reach, width - reach)
        left, right = best[:-step], best[step:]
        best = np.where(hashes[right] < hashes[left], right, left)
        reach += step
    return best


class _Anchors:
    """Anchors of a group of texts, by word numbers over the whole group."""

    def __init__(self, hasher: Hasher, found: Words, length: int):
        n, width = len(found.hash), length - GRAM + 1
        self.bounds = found.row_bounds()
        self.window_hash, self.window_at = hasher.grams(found, length, salt=1)
        grams, at = hasher.grams(found, GRAM)
        full = np.full(n, np.iinfo(np.uint64).max, np.uint64)
        full[at] = grams
        self.of_window = _smallest(full, width)[self.window_at] if len(self.window_at) else np.zeros(0, np.int64)
        self.at = np.unique(self.of_window)
        self.hash = full[self.at]
        row = found.row[self.at]
        self.row, self.begin = row, self.bounds[row]
        low = np.maximum(self.begin, self.at - (width - 1))
        high = np.minimum(self.bounds[row + 1], self.at + length)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(found.hash * hasher._words.up[:n])])
        around = (sums[high] - sums[low]) * hasher._words.down[low]
        sides = ((self.at - low) * 1024 + (high - self.at)).astype(np.uint64)
        self.around = mixed(around ^ mixed(sides, 5), 6)


def _seeds(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(lower=False)
        for batch in batches:
            for first, _, texts in groups(batch, "text"):
                found = _Anchors(hasher, hasher.words(texts), length)
                rows = pa.array(found.row + first)
                yield pa.record_batch(
                    [*[batch.column(k).take(rows) for k in KEYS], pa.array((found.at - found.begin).astype(np.int32)),
                     pa.array(found.hash.view(np.int64)), pa.array(found.around.view(np.int64))],
                    [*KEYS, "pos", "a", "around"])

    return run


def _edges(length: int):
    """Windows of the anchors at the given places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(lower=False)
        for batch in batches:
            for first, _, texts in groups(batch, "text"):
                words = hasher.words(texts)
                found = _Anchors(hasher, words, length)
                chosen = np.zeros(len(words.hash) + 1, bool)
                for i in range(len(texts)):
                    places = batch.column("places")[first + i].values.to_numpy()
                    chosen[found.bounds[i] + places] = True
                kept = np.flatnonzero(chosen[found.of_window])
                at = found.window_at[kept]
                anchor = found.hash[np.searchsorted(found.at, found.of_window[kept])]
                row = words.row[at]
                rows = pa.array(row + first)
                yield pa.record_batch(
                    [*[batch.column(k).take(rows) for k in KEYS], pa.array((at - found.bounds[row]).astype(np.int32)),
                     pa.array(anchor.view(np.int64)), pa.array(found.window_hash[kept].view(np.int64))],
                    [*KEYS, "pos", "a", "w"])

    return run


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the words of the spans (start * 256 + length each) out of each text; ``whole`` stands for all windows."""
    hasher = Hasher(lower=False)
    for batch in batches:
        spans, whole, limit = batch.column("spans"), batch.column("whole"), batch.column("window")
        for first, last, texts in groups(batch, "text"):
            found = hasher.words(texts)
            bounds = found.row_bounds()
            n, gone, kept, runs = [], [], [], []
            for i in range(last - first):
                size = int(bounds[i + 1] - bounds[i])
                mark = np.zeros(size + 1, np.int64)
                codes = spans[first + i]
                if whole[first + i].as_py():
                    if size >= limit[first + i].as_py():
                        mark[0], mark[size] = 1, -1
                elif codes.is_valid:
                    codes = codes.values.to_numpy()
                    start, end = codes // 256, np.minimum(codes // 256 + codes % 256, size)
                    np.add.at(mark, start, 1)
                    np.add.at(mark, end, -1)
                out = np.cumsum(mark[:size]) > 0
                change = np.flatnonzero(np.diff(np.concatenate([[0], out.astype(np.int8), [0]])))
                runs.append([{"start": int(s), "end": int(e)} for s, e in zip(change[::2], change[1::2])])
                left = np.flatnonzero(~out) + bounds[i]
                kept.append(b" ".join(found.data[s:e].tobytes() for s, e in zip(found.start[left], found.end[left])))
                n.append(size)
                gone.append(int(out.sum()))
            yield pa.record_batch(
                [batch.column("doc_id").slice(first, last - first), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                 pa.array(kept, pa.binary())], ["doc_id", "n_words", "n_removed", "spans", "kept"])


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """th1, th2, whole, spans for every text that has repeats: ``whole`` for texts with copies, else coded spans."""
    texts = _keyed(docs)
    place = F.xxhash64(*KEYS, "pos")
    seeds = settle(texts.mapInArrow(_seeds(length), f"{KEY_TYPES}, pos int, a long, around long"), "seeds").frame
    # The lists of anchors and windows are written before they are joined back: then both sides of a join come from
    # shuffles of their own, and the rows of a hot anchor can be split over tasks.
    several = settle(seeds.groupBy("a").agg(
        F.min(place).alias("low"), F.max(place).alias("high"), F.min("around").alias("r1"),
        F.max("around").alias("r2")).filter("low <> high").select("a", F.expr("r1 <> r2").alias("differ")),
        "several").frame
    met = settle(seeds.join(several, "a"), "met").frame
    differing = met.filter("differ")
    kinds = settle(differing.groupBy("a", "around").agg(F.min(place).alias("low"), F.max(place).alias("high")),
                   "kinds").frame
    judged = settle(
        differing.join(kinds, ["a", "around"]).select(
            *KEYS, "pos", F.expr("low <> high").alias("sure"), (place == F.col("low")).alias("first")), "judged").frame

    width = length - GRAM
    sure = met.filter("not differ").select(*KEYS, "pos").union(judged.filter("sure").select(*KEYS, "pos"))
    inside = sure.select(*KEYS, _coded(F.greatest(F.lit(0), F.col("pos") - width), F.col("pos") + length).alias("code"))

    edges = settle(judged.filter("not sure or first").groupBy(*KEYS).agg(F.collect_list("pos").alias("places")), "edges")
    opened = attach(texts, edges, {k: k for k in KEYS}, how="inner", tuning=LOOKUP)
    windows = settle(opened.select(*KEYS, "text", "places").mapInArrow(
        _edges(length), f"{KEY_TYPES}, pos int, a long, w long"), "windows").frame
    twice = settle(windows.groupBy("a", "w").agg(F.min(place).alias("low"), F.max(place).alias("high")).filter(
        "low <> high").select("a", "w"), "twice").frame
    outside = windows.join(twice, ["a", "w"], "left_semi").select(
        *KEYS, _coded(F.col("pos"), F.col("pos") + length).alias("code"))

    copies = texts.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*KEYS)
    found = inside.union(outside).groupBy(*KEYS).agg(F.collect_set("code").alias("spans"))
    return copies.withColumn("whole", F.lit(True)).withColumn("spans", F.lit(None).cast("array<long>")).union(
        found.join(copies, KEYS, "left_anti").select(*KEYS, F.lit(False).alias("whole"), "spans"))


def _coded(start, end):
    return (start.cast("long") * 256 + (end - start)).alias("code")


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id and text (as bytes) with the two hashes that stand for the text."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text")).select(
        "doc_id", "text", F.xxhash64("text").alias("th1"), F.xxhash64(F.lit(1), "text").alias("th2"))


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_words, n_removed, spans (maximal repeats, in words, ends exclusive) and kept (the words that are left,
    joined by one space) of every document. ``length`` is at most 128."""
    if not GRAM < length <= 128:
        raise ValueError(f"length must be above {GRAM} and at most 128")
    kind = docs.schema["doc_id"].dataType.simpleString()
    spans = settle(repeated_spans(docs, length), "spans")
    rows = attach(_keyed(docs), spans, {k: k for k in KEYS}, tuning=LOOKUP).select(
        "doc_id", "text", F.coalesce("whole", F.lit(False)).alias("whole"), "spans", F.lit(length).alias("window"))
    cut = rows.mapInArrow(_removed, f"doc_id {kind}, n_words long, n_removed long, "
                                    "spans array<struct<start:long,end:long>>, kept binary")
    return cut.withColumn("kept", F.col("kept").cast("string"))

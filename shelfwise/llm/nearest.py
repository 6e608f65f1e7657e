"""Approximate nearest neighbours with an inverted multi-index.

Vectors are cut into two halves, each quantised by its own codebook (k-means on a bounded sample, ``FIT_ROWS``). A
cell is a pair of centroids; every vector of the table is filed under its cell. A query visits cells in the order of
the summed distance of its halves to the two centroids, found by walking the two sorted lists with a heap, until the
visited cells hold enough vectors; those are reranked by their exact distance.

How many are enough is measured, not guessed: for a bounded sample of queries (``CHECK_QUERIES``) the true neighbours
are found by brute force over all vectors, and the depth is set so that at least ``TARGET_RECALL`` of them lie in the
visited cells. Data with clear clusters need few cells; data without structure need many, which the depth then shows.

Cells are laid into blocks of bounded size by their counts; a cell that is larger than a block, such as that of one
vector repeated in a third of all rows, is cut by a hash. A query goes once to each block that holds a cell it visits,
and a block meets its queries in groups of bounded size, so no task or pair list grows with the largest cell.

Defined cases: vectors that are null, zero, of another length than most, or hold null or non-finite components take no
part; equal vectors tie and the smaller id is nearer; with fewer candidates than neighbours all are returned; repeated
rows are queries and candidates of their own (a number written with each row tells them apart); an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm import ship
from shelfwise.operators.materialise import settle

ship(__name__)

FIT_ROWS = 20_000
CHECK_QUERIES = 100
TARGET_RECALL = 0.96
MAX_CENTROIDS = 256
CELL_ROWS = 16
BLOCK_ROWS = 4096
QUERY_BLOCK = 2048
ROUNDS = 12
FOUND = "query_row long, query_id long, vec_id long, score double"


@dataclass(frozen=True)
class Codebooks:
    left: np.ndarray
    right: np.ndarray

    @property
    def half(self) -> int:
        return self.left.shape[1]

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        """The cell number of each vector; in slices, as the distance tables are wide."""
        out = np.empty(len(vectors), np.int64)
        for at in range(0, len(vectors), 4096):
            part = vectors[at:at + 4096]
            out[at:at + 4096] = (_gaps(part[:, :self.half], self.left).argmin(1) * len(self.right)
                                 + _gaps(part[:, self.half:], self.right).argmin(1))
        return out

    def walk(self, query: np.ndarray) -> Iterator[int]:
        """Cells by rising summed distance."""
        a = ((self.left - query[:self.half]) ** 2).sum(1)
        b = ((self.right - query[self.half:]) ** 2).sum(1)
        first, second = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
        heap = [(a[first[0]] + b[second[0]], 0, 0)]
        while heap:
            _, i, j = heapq.heappop(heap)
            yield int(first[i] * len(b) + second[j])
            # The right neighbour is pushed by each pair, the lower one by the first of its row: each pair once.
            if j + 1 < len(b):
                heapq.heappush(heap, (a[first[i]] + b[second[j + 1]], i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (a[first[i + 1]] + b[second[0]], i + 1, 0))


def _gaps(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances up to a constant per point."""
    return (centroids ** 2).sum(1)[None, :] - 2.0 * points @ centroids.T


def _k_means(points: np.ndarray, k: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    distinct = np.unique(points, axis=0)
    centroids = distinct[rng.choice(len(distinct), min(k, len(distinct)), replace=False)].copy()
    for _ in range(ROUNDS):
        nearest = _gaps(points, centroids).argmin(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        counts = np.bincount(nearest, minlength=len(centroids))
        held = counts > 0
        centroids[held] = sums[held] / counts[held, None]
    return centroids


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """id and v (doubles) of the vectors that take part."""
    v = F.col("v")
    rows = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    fine = rows.filter(v.isNotNull() & (F.size(v) > 0)
                       & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
                       & F.exists(v, lambda x: x != 0))
    length = fine.groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), "n").first()
    return fine.filter(F.size(v) == (length["n"] if length else 0))


def _matrix(values) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.float64).reshape(len(values), -1)


def _filed(books: Codebooks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column("v")
            flat = lists.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            yield pa.record_batch(
                [batch.column("row"), batch.column("id"), pa.array(books.cells(flat), pa.int64()),
                 pa.array([row.tobytes() for row in flat], pa.binary())], ["row", "id", "cell", "v"])

    return run


def nearest_of(rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, query: np.ndarray, own: int,
               k: int) -> tuple[list, list]:
    """The k nearest rows but the query's own: ids and distances, ties to the smaller id."""
    gaps = np.sqrt(((vectors - query) ** 2).sum(1))
    gaps = np.where(rows == own, np.inf, gaps)
    if len(gaps) > k:
        near = np.flatnonzero(gaps <= np.partition(gaps, k - 1)[k - 1])
    else:
        near = np.arange(len(gaps))
    near = near[np.lexsort((ids[near], gaps[near]))][:k]
    near = near[np.isfinite(gaps[near])]
    return ids[near].tolist(), gaps[near].tolist()


def _best(found: DataFrame, k: int) -> DataFrame:
    first = Window.partitionBy("query_row").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)


def _brute(queries: Sequence[tuple[int, int, bytes]], k: int):
    """Partial results of a few queries over the rows of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, ids = batch.column("row").to_numpy(), batch.column("id").to_numpy()
            vectors = _matrix(batch.column("v").to_pylist())
            r, q, v, s = [], [], [], []
            for own, key, query in queries:
                near, gaps = nearest_of(rows, ids, vectors, np.frombuffer(query, np.float64), own, k)
                r += [own] * len(near)
                q += [key] * len(near)
                v += near
                s += gaps
            yield pa.record_batch([pa.array(r, pa.int64()), pa.array(q, pa.int64()), pa.array(v, pa.int64()),
                                   pa.array(s, pa.float64())], ["query_row", "query_id", "vec_id", "score"])

    return run


class Index:
    """All usable vectors, filed and written; ``search`` and ``recall`` read them."""

    def __init__(self, vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", fit_rows: int = FIT_ROWS):
        # Numbered and written, so the numbers stay as they are whatever is computed again.
        rows = settle(usable(vectors, key, vector).withColumn("row", F.monotonically_increasing_id()), "vectors").frame
        self.n = rows.count()
        if self.n == 0:
            self.filed, self.books, self.counts = rows.limit(0), None, {}
            return
        share = min(1.0, 2.0 * fit_rows / self.n)
        turn = F.pmod(F.xxhash64(F.lit("fit"), "id"), F.lit(1_000_000))
        sample = rows.filter(turn < share * 1_000_000).orderBy(turn, "id").limit(fit_rows).select("v").toPandas()["v"]
        points = np.stack([np.asarray(x, np.float64) for x in sample]) if len(sample) else np.ones(
            (1, len(rows.first()["v"])))
        half = points.shape[1] // 2
        k = int(max(1, min(MAX_CENTROIDS, len(points), (self.n / CELL_ROWS) ** 0.5)))
        self.books = Codebooks(_k_means(points[:, :half], k, 1) if half else np.zeros((1, 0)),
                               _k_means(points[:, half:], k, 2))
        self.filed = settle(rows.mapInArrow(_filed(self.books), "row long, id long, cell long, v binary"), "filed").frame
        # At most MAX_CENTROIDS squared numbers.
        self.counts = {r["cell"]: r["count"] for r in self.filed.groupBy("cell").count().collect()}

    def _blocks(self) -> tuple[dict[int, tuple[int, int]], int]:
        """cell: (first block, how many blocks it is cut into); small neighbouring cells share a block."""
        place: dict[int, tuple[int, int]] = {}
        block, held = 0, 0
        for cell in sorted(self.counts):
            n = self.counts[cell]
            if held and held + n > BLOCK_ROWS:
                block, held = block + 1, 0
            pieces = -(-n // BLOCK_ROWS)
            place[cell] = (block, pieces)
            held += n
            if pieces > 1:
                block, held = block + pieces, 0
        return place, block + 1

    def brute(self, queries: DataFrame, k: int = 10) -> DataFrame:
        """Exact neighbours of a bounded number of queries (row, id, v as bytes), which go to the driver and all tasks."""
        few = [(r["row"], r["id"], bytes(r["v"])) for r in queries.select("row", "id", "v").collect()]
        return _best(self.filed.mapInArrow(_brute(few, k), FOUND), k)

    def _checked(self, is_query: Column) -> DataFrame:
        """The queries in the order in which samples of them are taken."""
        return self.filed.filter(is_query).orderBy(F.xxhash64(F.lit("check"), "id"), "id", "row")

    def depth(self, is_query: Column, k: int = 10, target: float = TARGET_RECALL,
              queries: int = CHECK_QUERIES) -> int:
        """How many vectors the visited cells must hold to find ``target`` of the true neighbours."""
        checked = settle(self._checked(is_query).limit(queries), "checked").frame
        true = self.brute(checked, k).select("query_row", F.col("vec_id").alias("id"))
        cells = true.join(self.filed.select("id", "cell"), "id").groupBy("query_row").agg(
            F.collect_list("cell").alias("cells")).collect()  # k numbers for each checked query
        wanted = {r["query_row"]: r["cells"] for r in cells}
        needed: list[int] = []
        for row in checked.collect():
            left, seen = list(wanted.get(row["row"], [])), 0
            for cell in self.books.walk(np.frombuffer(bytes(row["v"]), np.float64)):
                if not left:
                    break
                hits = left.count(cell)
                needed += [seen + 1] * hits
                left = [c for c in left if c != cell]
                seen += self.counts.get(cell, 0)
        needed.sort()
        return needed[min(len(needed) - 1, int(np.ceil(target * len(needed))) - 1)] if needed else self.n

    def search(self, is_query: Column, k: int = 10, depth: int | None = None) -> DataFrame:
        """query_id, rank, vec_id and score for every filed row that ``is_query`` (over ``id``) marks."""
        if self.n == 0:
            return self.filed.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"),
                                     F.lit(0.0).alias("score"))
        queries = self.filed.filter(is_query)
        n_queries = queries.count()
        depth = self.depth(is_query, k) if depth is None else depth
        books, counts, (place, n_blocks) = self.books, self.counts, self._blocks()
        groups = max(1, -(-n_queries // QUERY_BLOCK))

        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """One row for each block a query visits, with the cells it opens there."""
            for batch in batches:
                rows, ids, vecs, blocks, cells = [], [], [], [], []
                for row, own, raw in zip(batch.column("row").to_pylist(), batch.column("id").to_pylist(),
                                         batch.column("v").to_pylist()):
                    opened: dict[int, list[int]] = {}
                    seen = 0
                    for cell in books.walk(np.frombuffer(raw, np.float64)):
                        if seen >= max(depth, k + 1):
                            break
                        if n := counts.get(cell):
                            seen += n
                            first, pieces = place[cell]
                            for block in range(first, first + pieces):
                                opened.setdefault(block, []).append(cell)
                    rows += [row] * len(opened)
                    ids += [own] * len(opened)
                    vecs += [raw] * len(opened)
                    blocks += opened.keys()
                    cells += [np.asarray(c, np.int32).tobytes() for c in opened.values()]
                yield pa.record_batch([pa.array(rows, pa.int64()), pa.array(ids, pa.int64()),
                                       pa.array(vecs, pa.binary()), pa.array(blocks, pa.int64()),
                                       pa.array(cells, pa.binary())], ["row", "id", "v", "block", "cells"])

        def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = [place[c] for c in batch.column("cell").to_pylist()]
                turn = batch.column("turn").to_pylist()
                blocks = [first + t % pieces for (first, pieces), t in zip(at, turn)]
                yield pa.record_batch([batch.column("row"), batch.column("id"), batch.column("cell"), batch.column("v"),
                                       pa.array(blocks, pa.int64())], ["row", "id", "cell", "v", "block"])

        n_cells = len(books.left) * len(books.right)

        def rerank(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(left) and len(right):
                rows, ids, cells = right["row"].to_numpy(), right["id"].to_numpy(), right["cell"].to_numpy()
                vectors = _matrix(right["v"].tolist())
                for own, key, raw, opened in zip(left["row"], left["id"], left["v"], left["cells"]):
                    mark = np.zeros(n_cells, bool)
                    mark[np.frombuffer(opened, np.int32)] = True
                    met = np.flatnonzero(mark[cells])
                    near, gaps = nearest_of(rows[met], ids[met], vectors[met], np.frombuffer(raw, np.float64), own, k)
                    out += [(own, key, v, s) for v, s in zip(near, gaps)]
            return pd.DataFrame(out, columns=["query_row", "query_id", "vec_id", "score"]).astype(
                {"query_row": "int64", "query_id": "int64", "vec_id": "int64", "score": "float64"})

        group = F.pmod(F.xxhash64(F.lit("group"), "row"), F.lit(groups))
        # Dealt by a hash first: queries lie unevenly in the files, and each costs a walk.
        routed = queries.repartition(F.xxhash64("row")).mapInArrow(
            visit, "row long, id long, v binary, block long, cells binary").withColumn("grp", group)
        turned = self.filed.withColumn("turn", F.pmod(F.xxhash64(F.lit("block"), "row"), F.lit(1 << 30)))
        laid = turned.mapInArrow(lay, "row long, id long, cell long, v binary, block long")
        if groups == 1:
            laid = laid.withColumn("grp", F.lit(0).cast("long"))
        else:
            routed = settle(routed, "routed").frame
            laid = laid.join(routed.select("block", "grp").distinct(), "block")
        routed = routed.withColumn("grp", F.col("grp").cast("long"))
        found = routed.groupBy("block", "grp").cogroup(laid.groupBy("block", "grp")).applyInPandas(rerank, FOUND)
        return _best(found, k).select("query_id", "rank", "vec_id", "score")

    def recall(self, is_query: Column, found: DataFrame, k: int = 10, queries: int = CHECK_QUERIES) -> float:
        """The share of true neighbours among those found, over a bounded sample of queries that ``depth`` did not
        use; where there are no others, over those."""
        few = settle(self._checked(is_query).offset(CHECK_QUERIES).limit(queries), "recall").frame
        few = self._checked(is_query).limit(queries) if few.isEmpty() else few
        true = self.brute(few, k).select("query_id", "vec_id")
        n = true.count()
        return true.join(found.select("query_id", "vec_id"), ["query_id", "vec_id"], "left_semi").count() / max(n, 1)

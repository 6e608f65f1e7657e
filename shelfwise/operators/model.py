"""Error classifier and level corrector on ``pyspark.ml``."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.labels import level_target
from shelfwise.operators.materialise import settle
from shelfwise.operators.metrics import class_weights
from shelfwise.operators.numbering import number_in_order

HIDDEN = 128
# Starts of paths that a prediction keeps from bit to bit.
BEAM = 8
# Label paths whose tree is broadcast at once: at most eight bytes for each path and bit.
BLOCK_PATHS = 100_000
SLICE_ROWS = 512
# The end of a fit and the steps it keeps, as LogisticRegression has them.
TOLERANCE, MEMORY, VALUES = 1e-6, 10, 20
# The perceptron takes no weights, so rows are repeated, each class up to about so many times its share.
FINEST_REPEAT = 8


def _weights(train: DataFrame, label: str) -> dict[int, float]:
    return {line["label"]: line["weight"] for line in class_weights(train, label).collect()}  # two lines


def train_error_model(train: DataFrame, label: str = "is_error", features: str = "features", kind: str = "logistic",
                      epochs: int = 100, start_from: Model | None = None) -> PipelineModel:
    """Fit P(row is wrong). Classes are balanced by weights, or by repeating rows for the perceptron, which takes
    no weights. ``start_from`` continues a perceptron from earlier weights."""
    if start_from is not None and kind != "perceptron":
        raise ValueError("only a perceptron can be trained on from earlier weights")
    weights = _weights(train, label)
    ready = train.withColumn("__label", F.col(label).cast("int").cast("double"))
    if kind == "logistic":
        weight = F.when(F.col("__label") == 1, weights[1]).otherwise(weights[0])
        fit = LogisticRegression(featuresCol=features, labelCol="__label", weightCol="__weight", maxIter=epochs,
                                 regParam=1e-4, probabilityCol="__probability", rawPredictionCol="__raw",
                                 predictionCol="__prediction", family="binomial")
        model = fit.fit(ready.withColumn("__weight", weight))
    elif kind == "perceptron":
        # The ratio of the weights as a fraction of small numbers: 1.4 to 1 repeats one class 7 times, the other 5.
        ratio = Fraction(weights[1] / weights[0]).limit_denominator(FINEST_REPEAT) if weights[1] >= weights[0] else (
            1 / Fraction(weights[0] / weights[1]).limit_denominator(FINEST_REPEAT))
        times = F.when(F.col("__label") == 1, ratio.numerator).otherwise(ratio.denominator)
        copies = ready.withColumn("__again", F.explode(F.sequence(F.lit(1), times)))
        # The copies of one row are spread over all tasks.
        balanced = copies.repartition(F.xxhash64("__again", F.monotonically_increasing_id())).drop("__again")
        width = len(train.select(features).first()[0])
        fit = MultilayerPerceptronClassifier(featuresCol=features, labelCol="__label", maxIter=epochs, seed=1,
                                             layers=[width, HIDDEN, HIDDEN, 2], probabilityCol="__probability",
                                             rawPredictionCol="__raw", predictionCol="__prediction")
        if start_from is not None:
            fit.setInitialWeights(start_from.stages[-1].weights)
        model = fit.fit(balanced)
    else:
        raise ValueError(f"unknown model kind {kind!r}: use logistic or perceptron")
    return PipelineModel(stages=[model])


def score_errors(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``pred_is_error`` (0/1) and ``pred_probs``, the probability of an error."""
    return (
        model.transform(df)
        .withColumn("pred_is_error", F.col("__prediction").cast("int"))
        .withColumn("pred_probs", vector_to_array("__probability")[1])
        .drop("__prediction", "__probability", "__raw")
    )


@dataclass(frozen=True)
class LevelModels:
    """Predicts the labels of all levels together, bit by bit on the tree of the label paths seen in training.

    The number of a label is a row of bits, and a path (one label a level) the bits of its labels one after the other.
    Each bit is given by a logistic model of the features and of the bits before it, so the size of the model grows
    with the logarithm of the number of labels. A prediction follows the ``BEAM`` most probable starts of real paths
    through the bits, so parents say which children are possible and the result is always a path that occurred.
    """

    levels: tuple[str, ...]
    bits: tuple[int, ...]  # of each level
    weights: np.ndarray  # a line per bit: features, earlier bits, constant
    paths: DataFrame  # block and path (array of numbers), each once

    def predict(self, df: DataFrame, features: str = "features") -> DataFrame:
        """Add ``pred_<level>_idx``. The tree is read in blocks of at most ``BLOCK_PATHS`` paths, each one pass over
        the rows; the best path of all blocks stands."""
        spark = df.sparkSession
        names = [f"pred_{c}_idx" for c in self.levels]
        share = spark.sparkContext.broadcast
        weights, size = share(self.weights), self.weights.shape[1] - len(self.weights) - 1
        found = df.select("*", *[F.lit(None).cast("int").alias(n) for n in names], F.lit(None).cast("double").alias("__best"))
        blocks = sorted(line["block"] for line in self.paths.select("block").distinct().collect())
        for at, block in enumerate(blocks):
            lines = self.paths.filter(F.col("block") == block).select("path").collect()
            tree = share(label_tree(np.array([line["path"] for line in lines], np.int64), self.bits))
            found = found.mapInArrow(_follow(tree, weights, size, features, names), found.schema)
            if at < len(blocks) - 1:
                found = settle(found, "predicted").frame
        return found.drop("__best")

    def save(self, spark: SparkSession, path: str) -> None:
        self.paths.write.mode("overwrite").parquet(f"{path}/paths")
        spark.createDataFrame([(list(self.levels), list(self.bits))], "levels array<string>, bits array<int>").write.mode(
            "overwrite").parquet(f"{path}/levels")
        lines = [(i, line.tolist()) for i, line in enumerate(self.weights)]
        spark.createDataFrame(lines, "bit int, weights array<double>").write.mode("overwrite").parquet(f"{path}/weights")

    @staticmethod
    def load(spark: SparkSession, path: str) -> LevelModels:
        shape = spark.read.parquet(f"{path}/levels").first()
        lines = spark.read.parquet(f"{path}/weights").orderBy("bit").collect()
        return LevelModels(tuple(shape["levels"]), tuple(shape["bits"]), np.array([line["weights"] for line in lines]),
                           spark.read.parquet(f"{path}/paths"))


def _path_bits(paths: np.ndarray, bits: Sequence[int]) -> np.ndarray:
    """Paths as bits, those of the first level first, the highest first in each."""
    return np.concatenate([(paths[:, [j]] >> np.arange(n - 1, -1, -1)) & 1 for j, n in enumerate(bits)], axis=1)


def label_tree(paths: np.ndarray, bits: Sequence[int]) -> tuple[list[np.ndarray], np.ndarray]:
    """For each bit the node that follows each node by 0 and by 1 (-1: no path goes there), and the paths in the order
    of the last nodes."""
    paths = np.unique(paths, axis=0)
    coded = _path_bits(paths, bits)
    steps, node = [], np.zeros(len(paths), np.int32)
    for i in range(coded.shape[1]):
        new = np.append(True, (node[1:] != node[:-1]) | (coded[1:, i] != coded[:-1, i]))
        after = (np.cumsum(new) - 1).astype(np.int32)
        step = np.full((2, int(node[-1]) + 1), -1, np.int32)
        step[coded[:, i], node] = after
        steps.append(step)
        node = after
    return steps, paths.astype(np.int32)


def _sparse_rows(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and values of each vector."""
    kinds, places, values = (column.field(c) for c in ("type", "indices", "values"))
    for kind, at, value in zip(kinds, places, values):
        filled = value.values.to_numpy()
        yield (at.values.to_numpy() if kind.as_py() == 0 else np.arange(len(filled))), filled


def _follow(tree, weights, size: int, features: str, names: Sequence[str]):
    """Mapper: the best path of one block of the tree, where it beats the best one so far."""
    def best_paths(base: np.ndarray, steps: list[np.ndarray], earlier: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = np.arange(len(base))[:, None]
        node = np.zeros((len(base), 1), np.int32)
        score = np.zeros((len(base), 1))
        past = np.zeros((len(base), 1, len(steps)))
        for i, step in enumerate(steps):
            logit = base[:, [i]] + past[:, :, :i] @ earlier[i, :i]
            after = np.concatenate([step[0][node], step[1][node]], axis=1)
            gained = np.concatenate([score - np.logaddexp(0, logit), score - np.logaddexp(0, -logit)], axis=1)
            gained[after < 0] = -np.inf
            top = np.argsort(-gained, axis=1, kind="stable")[:, :BEAM]
            from_one = top >= node.shape[1]
            past = past[rows, top % node.shape[1]]
            past[:, :, i] = from_one
            node, score = np.maximum(after[rows, top], 0), gained[rows, top]
        return node[:, 0], score[:, 0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (steps, paths), w = tree.value, weights.value
        by_place, earlier, constant = np.ascontiguousarray(w[:, :size].T), w[:, size:-1], w[:, -1]
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                base = np.array([value @ by_place[place] for place, value in _sparse_rows(part.column(features))]) + constant
                leaf, score = best_paths(base, steps, earlier)
                before = part.column("__best").to_numpy(zero_copy_only=False).astype(float)
                better = np.isnan(before) | (score > before)
                new = {"__best": pa.array(np.where(better, score, before))}
                for j, name in enumerate(names):
                    old = part.column(name).fill_null(0).to_numpy(zero_copy_only=False)
                    new[name] = pa.array(np.where(better, paths[leaf, j], old).astype(np.int32))
                yield pa.record_batch([new.get(c, part.column(c)) for c in part.schema.names], part.schema.names)

    return run


def _packed(bits: Sequence[int], features: str):
    """Mapper: slices of rows as arrays, each with the features of its rows once, whatever the number of bits: places
    and values of the vectors, the row of each value, the bits of the labels and which of them are known."""
    level = np.repeat(np.arange(len(bits)), bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                targets = np.array([part.column(f"__t{j}").fill_null(-1).to_numpy() for j in range(len(bits))]).T
                places, values = zip(*_sparse_rows(part.column(features)))
                used, column = np.unique(np.concatenate(places), return_inverse=True)
                row = np.repeat(np.arange(len(places)), [len(place) for place in places])
                known = targets[:, level] >= 0
                coded = (_path_bits(np.maximum(targets, 0), bits) * known).astype(bool)
                slices = pickle.dumps((used, row.astype(np.int32), column.astype(np.int32), np.concatenate(values), coded, known))
                yield pa.record_batch([pa.array([slices], pa.binary())], ["slice"])

    return run


def _matrices(packed: bytes) -> tuple[np.ndarray, ...]:
    """Places in use, the features on these places, the bits and which are known, all but the first as numbers."""
    used, row, column, values, coded, known = pickle.loads(packed)
    x = np.zeros((len(coded), len(used)))
    x[row, column] = values
    return used, x, coded.astype(float), known.astype(float)


def _moments(width: int, size: int):
    """Sums and sums of squares of each input of each bit, over the rows that know the bit."""
    def run(slices: Iterator[bytes]) -> Iterator[np.ndarray]:
        total = None
        for packed in slices:
            used, x, coded, known = _matrices(packed)
            if total is None:
                total = np.zeros((2, known.shape[1], width))
            total[0][:, used] += known.T @ x
            total[1][:, used] += known.T @ (x * x)
            earlier = np.tril(known.T @ coded, -1)
            for sums in total:
                sums[:, size:-1] += earlier
                sums[:, -1] += known.sum(axis=0)
        if total is not None:
            yield total

    return run


def _loss(weights, size: int):
    """Sum of the logistic losses of all bits and its gradient, the loss in the last place."""
    def run(slices: Iterator[bytes]) -> Iterator[np.ndarray]:
        w, total = weights.value, None
        earlier = np.tril(w[:, size:-1], -1)
        for packed in slices:
            used, x, coded, known = _matrices(packed)
            if total is None:
                total = np.zeros(w.size + 1)
            gradient = total[:-1].reshape(w.shape)
            margin = x @ w[:, used].T + coded @ earlier.T + w[:, -1]
            soft = np.logaddexp(0, margin)
            total[-1] += (known * (soft - coded * margin)).sum()
            apart = known * (np.exp(margin - soft) - coded)
            gradient[:, used] += apart.T @ x
            gradient[:, size:-1] += np.tril(apart.T @ coded, -1)
            gradient[:, -1] += apart.sum(axis=0)
        if total is not None:
            yield total

    return run


def _minimum(of: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, epochs: int) -> np.ndarray:
    """L-BFGS for a convex function, ended as ``LogisticRegression`` ends it."""
    at, (value, slope), steps = start, of(start), []
    first, values = value, [value]
    for _ in range(epochs):
        if np.linalg.norm(slope) <= max(TOLERANCE * abs(value), 1e-8):
            break
        way, shares = slope.copy(), []
        for moved, turned, inverse in reversed(steps):
            shares.append(inverse * (moved @ way))
            way -= shares[-1] * turned
        way *= 1 / np.linalg.norm(slope) if not steps else 1 / (steps[-1][2] * (steps[-1][1] @ steps[-1][1]))
        for (moved, turned, inverse), share in zip(steps, reversed(shares)):
            way += (share - inverse * (turned @ way)) * moved
        length, gain = 1.0, slope @ way
        new, (new_value, new_slope) = at - way, of(at - way)
        while new_value > value - 1e-4 * length * gain and length > 1e-6:
            length /= 2
            new = at - length * way
            new_value, new_slope = of(new)
        if new_value >= value:
            break
        moved, turned = new - at, new_slope - slope
        if moved @ turned > 0:
            steps = [*steps[1 - MEMORY:], (moved, turned, 1 / (moved @ turned))]
        at, value, slope = new, new_value, new_slope
        if max(values) - value <= TOLERANCE * first:
            break
        values = [*values, value][-VALUES:]
    return at


def _fit_bits(packed: RDD, bits: int, size: int, epochs: int, penalty: float = 1e-4) -> np.ndarray:
    """The weights of all bits, a line per bit: what one ``LogisticRegression`` over a line for each bit of each row
    gives (places of its own for each bit, no intercept, inputs scaled by their deviation over all lines), without
    such lines. A pass sums one gradient a task, task by task in a tree."""
    width = size + bits + 1
    sums, squares = packed.mapPartitions(_moments(width, size)).treeReduce(np.add)
    lines = sums[:, -1].sum()
    spread = np.sqrt(np.maximum(squares - sums * sums / lines, 0) / max(lines - 1, 1))
    scale = np.divide(1, spread, out=np.zeros_like(spread), where=spread > 0)

    def of(flat: np.ndarray) -> tuple[float, np.ndarray]:
        weights = packed.context.broadcast(flat.reshape(scale.shape) * scale)
        total = packed.mapPartitions(_loss(weights, size)).treeReduce(np.add)
        weights.destroy()
        return (total[-1] / lines + penalty / 2 * (flat @ flat), total[:-1] * scale.ravel() / lines + penalty * flat)

    return _minimum(of, np.zeros(scale.size), epochs).reshape(scale.shape) * scale


def train_level_models(train: DataFrame, levels: Sequence[str], label: str = "is_error", features: str = "features",
                       prefix: str = "correct_", epochs: int = 100) -> LevelModels:
    """Fit the bits of all levels together, one job for each pass. A wrong row teaches its corrected levels."""
    absent = [f"{prefix}{c}_idx" for c in levels if f"{prefix}{c}_idx" not in train.columns]
    if absent:
        raise ValueError(f"no corrected level to learn from: {absent}")
    wrong = F.col(label).cast("int") == 1
    names = [f"__t{j}" for j in range(len(levels))]
    targets = settle(train.select(features, *[level_target(c, wrong, prefix).cast("long").alias(t)
                                              for t, c in zip(names, levels)]), "targets").frame
    tops = targets.agg(*[F.max(t).alias(t) for t in names]).first()
    for t, c in zip(names, levels):
        if tops[t] is None:
            raise ValueError(f"level {c!r} has no rows to learn from")
    bits = tuple(max(1, int(tops[t]).bit_length()) for t in names)
    paths = targets.select(*names).dropna().distinct()
    paths = number_in_order(paths.withColumn("__all", F.lit(0)), "__all", names, "__number", 0)
    paths = settle(paths.select(F.floor(F.col("__number") / BLOCK_PATHS).alias("block"), F.array(*names).alias("path")), "paths").frame
    if paths.isEmpty():
        raise ValueError("no row has a label on every level")
    size = len(targets.select(features).first()[0])
    slices = settle(targets.mapInArrow(_packed(bits, features), "slice binary"), "slices").frame
    packed = slices.rdd.map(lambda line: bytes(line["slice"])).persist(StorageLevel.MEMORY_AND_DISK)
    weights = _fit_bits(packed, sum(bits), size, epochs)
    packed.unpersist()
    return LevelModels(tuple(levels), bits, weights, paths)

"""N-gram Jaccard join with a token-group matrix.

Documents are sets of word shingles. Similar sets are put into groups, the tokens of each group are kept as a union
(the rows of the token-group matrix), and a set is compared with the members of a group only where its overlap with
the union could reach the threshold. All bounds are exact: no link between different sets is lost.

1. Sets are hashed in one pass. Equal sets are one vertex from here on, so copies cost nothing.
2. Most sets are ruled out by a short sample: of the n(1-t)+l smallest token hashes of a set, l must be shared with a
   linked set. Tokens are counted over these samples; sets with too few shared ones have no link.
3. The rest are read in full. Tokens of a single set are dropped (only their number counts), the others are put in
   order of rising document frequency, and tokens in the prefix of that order become postings.
4. Grouping: each posting list has a leader, the set with the fewest rare tokens; members are compared with their
   leaders only, the most common leader first, so work is linear in the list. Linked sets form groups.
5. Posting lists that meet two or more groups give (set, group) candidates, cut by length and position bounds. The
   union bound decides which groups are opened, and members of opened groups are compared exactly.
6. Groups and late links are joined to components.

Defined cases: sets without words are linked with nothing (component: the own id); null ids are kept, and a component
of null ids only is null; rows with equal ids are handled each by itself; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from shelfwise.llm import ship
from shelfwise.llm.common import LOOKUP
from shelfwise.llm.components import components
from shelfwise.llm.wordhash import Hasher, groups, lists, mixed
from shelfwise.operators.joins import attach
from shelfwise.operators.materialise import Settled, settle

ship(__name__)


def least_size(n, percent: int):
    """The smallest set that can be linked with one of n tokens."""
    return (n * percent + 99) // 100


def sample_extra(n, percent: int, share: int):
    """How many sampled tokens must be shared: one in ``share`` of those a linked set may lack, and one."""
    return (n - least_size(n, percent)) // share + 1


def _sets(texts: list[bytes | None], hasher: Hasher, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the texts, sorted within each text, and their numbers."""
    found = hasher.words(texts)
    bounds = found.row_bounds()
    hashes, at = hasher.grams(found, k)
    rows = found.row[at]
    n_words = np.diff(bounds)
    short = np.flatnonzero((n_words > 0) & (n_words < k))
    hashes = np.concatenate([hashes, hasher.whole(found, short, bounds)])
    rows = np.concatenate([rows, short])
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    return hashes[fresh], np.bincount(rows[fresh], minlength=len(texts))


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs, wrapping."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values)])
    ends = np.cumsum(counts)
    return (total[ends] - total[ends - counts]).view(np.int64)


def _sketched(k: int, percent: int, share: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(lower=True)
        for batch in batches:
            for first, last, texts in groups(batch, "__text"):
                hashes, n = _sets(texts, hasher, k)
                starts = np.cumsum(n) - n
                length = np.where(n > 0, n - least_size(n, percent) + sample_extra(n, percent, share), 0)
                rank = np.arange(len(hashes)) - np.repeat(starts, n)
                kept = hashes[rank < np.repeat(length, n)]
                yield pa.record_batch(
                    [batch.column("doc_id").slice(first, last - first), pa.array(n, pa.int64()),
                     pa.array(_sums(mixed(hashes, 31), n)), pa.array(_sums(mixed(hashes, 32), n)),
                     batch.column("th").slice(first, last - first), lists(kept.view(np.int64), length)],
                    ["doc_id", "n", "s1", "s2", "th", "sample"])

    return run


def _in_full(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(lower=True)
        for batch in batches:
            for first, last, texts in groups(batch, "text"):
                hashes, n = _sets(texts, hasher, k)
                yield pa.record_batch(
                    [batch.column("v").slice(first, last - first), pa.array(n, pa.int64()),
                     pa.array(_sums(mixed(hashes, 31), n)), pa.array(_sums(mixed(hashes, 32), n)),
                     lists(hashes.view(np.int64), n)], ["v", "n", "s1", "s2", "tokens"])

    return run


def _ceil_div(a: Column, b: int) -> Column:
    return F.floor((a + (b - 1)) / b).cast("long")


class _Join:
    """The sets that can have links, in frequency order, and how pairs of them are compared."""

    def __init__(self, sets: DataFrame, percent: int):
        self.sets, self.percent = sets, percent

    def overlap(self, n1: Column, n2: Column) -> Column:
        """Common tokens that two sets of these sizes need."""
        return _ceil_div((n1 + n2) * self.percent, 100 + self.percent)

    def sizes_fit(self, n1: Column, n2: Column) -> Column:
        return (F.least(n1, n2) * 100 >= F.greatest(n1, n2) * self.percent)

    def linked(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) that are linked."""
        left = self.sets.select(F.col("v").alias("a"), F.col("n").alias("n1"), F.col("tokens").alias("t1"))
        right = self.sets.select(F.col("v").alias("b"), F.col("n").alias("n2"), F.col("tokens").alias("t2"))
        both = pairs.join(left, "a").join(right, "b")
        common = F.size(F.array_intersect("t1", "t2"))
        return both.filter(common >= self.overlap(F.col("n1"), F.col("n2"))).select("a", "b")


def _candidate_sets(docs: DataFrame, sketch: Settled, k: int, percent: int, share: int) -> tuple[DataFrame, DataFrame]:
    """(vertices, full token sets of those that can have links)."""
    sampled_vertices = settle(
        sketch.frame.filter("n > 0").groupBy("s1", "s2", "n").agg(
            F.min("doc_id").alias("id"), F.min("th").alias("th"), F.any_value("sample").alias("sample"))
        .withColumn("v", F.monotonically_increasing_id()), "vertices")
    sketch.delete()
    # From here on the samples are only needed once more, so the wide tables go as soon as they are read.
    vertices = settle(sampled_vertices.frame.drop("sample"), "vertices").frame
    sampled = sampled_vertices.frame.select("v", F.explode("sample").alias("t"))
    # A set has a token once and is one vertex, so two rows are two sets.
    # Written, so that the join below reads both sides from shuffles of their own and a hot token can be split.
    shared = settle(sampled.groupBy("t").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1").select("t"),
                    "shared").frame
    # The smallest linked partner has the shortest sample; so many tokens are shared with it at least.
    least = _ceil_div(F.col("n") * percent, 100)
    needed = F.floor((least - _ceil_div(least * percent, 100)) / share).cast("long") + 1
    hits = settle(sampled.join(shared, "t", "left_semi").groupBy("v").agg(F.count(F.lit(1)).alias("hits")), "hits")
    sampled_vertices.delete()
    able = settle(vertices.join(hits.frame, "v").filter(F.col("hits") >= needed).select("v", "th", "s1", "s2"), "able")
    keys = able.narrowed(able.frame.select("th", "v"))
    texts = docs.select("text").withColumn("th", F.xxhash64("text"))
    # A text hash may stand for several vertices only if hashes collide; the signatures below keep them apart.
    found = attach(texts, keys, {"th": "th"}, how="inner", tuning=LOOKUP).groupBy("v").agg(F.any_value("text").alias("text"))
    full = found.select("v", F.col("text").cast("binary").alias("text")).mapInArrow(
        _in_full(k), "v long, n long, s1 long, s2 long, tokens array<long>")
    return vertices, settle(full.join(able.frame.select("v", "s1", "s2"), ["v", "s1", "s2"], "left_semi"), "full").frame


def _ordered_sets(full: DataFrame, percent: int) -> DataFrame:
    """v, n, tokens: the tokens that occur in several sets, the rarest first."""
    flat = full.select("v", F.explode("tokens").alias("t"))
    counts = settle(flat.groupBy("t").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "counts").frame
    kept = flat.join(counts, "t").groupBy("v").agg(F.sort_array(F.collect_list(F.struct("df", "t"))).alias("s"))
    able = kept.join(full.select("v", "n"), "v").filter(F.size("s") >= _ceil_div(F.col("n") * percent, 100))
    return settle(able.select("v", "n", F.col("s.t").alias("tokens")), "sets").frame


def _links(join: _Join) -> DataFrame:
    sets, percent = join.sets, join.percent
    n, place = F.col("n"), F.col("place")
    longest = n - _ceil_div(n * percent, 100) + 1
    rare = n - F.size("tokens")
    prefix = F.slice("tokens", F.lit(1), F.greatest(F.lit(0), (longest - rare).cast("int")))
    flat = sets.select("v", "n", rare.alias("rare"), F.posexplode(prefix).alias("i", "t")).select(
        "v", "n", "t", (F.col("rare") + F.col("i")).cast("long").alias("place"))
    several = flat.groupBy("t").agg(F.min("v").alias("low"), F.max("v").alias("high")).filter("low <> high").select("t")
    postings = settle(flat.join(several, "t", "left_semi"), "postings").frame

    # Leaders: the set that has the token at the front, so it has the fewest rare tokens.
    leaders = postings.groupBy("t").agg(F.min(F.struct("place", "v", "n")).alias("lead"))
    pairs = postings.join(leaders, "t").filter(
        (F.col("v") != F.col("lead.v")) & join.sizes_fit(n, F.col("lead.n"))).select(
        F.col("v").alias("a"), F.col("lead.v").alias("b")).distinct()
    stars = settle(pairs, "stars").frame
    popular = stars.groupBy("b").agg(F.count(F.lit(1)).alias("pop"))
    first = stars.join(popular, "b").groupBy("a").agg(F.max(F.struct("pop", "b"))["b"].alias("b"))
    links = settle(join.linked(first), "links").frame
    labels = components(links)

    def label(rows: DataFrame, column: str, out: str, of: DataFrame) -> DataFrame:
        marks = of.select(F.col("v").alias("__v"), F.col("label").alias("__l"))
        return rows.join(marks, F.col(column) == F.col("__v"), "left").withColumn(
            out, F.coalesce("__l", column)).drop("__v", "__l")

    apart = label(label(stars, "a", "la", labels), "b", "lb", labels).filter("la <> lb").select("a", "b")
    links = settle(links.union(join.linked(apart)), "links").frame
    labels = components(links)

    # Token-group matrix: postings by group, where a token meets several groups.
    grouped = settle(label(postings, "v", "g", labels), "grouped").frame
    meeting = grouped.groupBy("t").agg(F.min("g").alias("low"), F.max("g").alias("high")).filter(
        "low <> high").select("t")
    met = settle(grouped.join(meeting, "t", "left_semi"), "met").frame
    rows = met.groupBy("t", F.col("g").alias("h")).agg(
        F.min("n").alias("low_n"), F.max("n").alias("high_n"), F.max(n - place).alias("rest"))
    # The smaller set of a pair is the query; its shorter prefix is enough.
    queries = met.filter(place < n - _ceil_div(n * (2 * percent), 100 + percent) + 1)
    larger = F.greatest(n, F.col("low_n"))
    fitting = ((F.col("g") != F.col("h")) & (F.col("high_n") >= n) & join.sizes_fit(n, larger)
               & (F.least(n - place, F.col("rest")) >= join.overlap(n, larger)))
    candidates = settle(queries.join(rows, "t").filter(fitting).select("v", "n", "h").distinct(), "candidates").frame
    members = label(sets.select("v", "n", "tokens"), "v", "h", labels).join(
        candidates.select("h").distinct(), "h", "left_semi")
    matrix = members.select("h", F.explode("tokens").alias("t")).distinct()
    bound = (candidates.join(sets.select("v", F.explode("tokens").alias("t")), "v").join(matrix, ["h", "t"])
             .groupBy("v", "n", "h").agg(F.count(F.lit(1)).alias("most")))
    opened = bound.filter(F.col("most") >= join.overlap(n, n)).select(F.col("v").alias("a"), F.col("n").alias("na"), "h")
    inside = members.select("h", F.col("v").alias("b"), F.col("n").alias("nb"))
    late = opened.join(inside, "h").filter(
        (F.col("nb") >= F.col("na")) & join.sizes_fit(F.col("na"), F.col("nb"))).select("a", "b")
    return links.union(join.linked(late))


def _sketch(docs: DataFrame, k: int, percent: int, share: int) -> Settled:
    """doc_id, size and signatures of the set, text hash and sample of every row."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("__text"),
                         F.xxhash64("text").alias("th"))
    return settle(source.mapInArrow(
        _sketched(k, percent, share), "doc_id long, n long, s1 long, s2 long, th long, sample array<long>"),
        "sketch")


def _labelled(docs: DataFrame, sketch: Settled, k: int, percent: int, share: int) -> DataFrame:
    """v, id, s1, s2, n and label of every set with words; linked sets have one label. Deletes the sketch."""
    vertices, full = _candidate_sets(docs, sketch, k, percent, share)
    labels = components(_links(_Join(_ordered_sets(full, percent), percent)))
    return vertices.select("v", "id", "s1", "s2", "n").join(labels, "v", "left").withColumn(
        "label", F.coalesce("label", "v"))


def near_components(docs: DataFrame, k: int = 5, percent: int = 80, share: int = 1) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest id reachable by links) of every document.

    ``docs`` has doc_id (a whole number) and text. Two documents are linked when their sets of ``k``-word shingles,
    with A to Z in lower case, have a Jaccard similarity of ``percent`` hundredths or more. ``share`` sets the length
    of the sample: 1 rules out most where many shingles are common by chance, 4 is shorter where few are.
    """
    sketch = _sketch(docs, k, percent, share)
    rows = settle(sketch.frame.select("doc_id", "n", "s1", "s2"), "rows").frame
    ids = _labelled(docs, sketch, k, percent, share)
    smallest = ids.groupBy("label").agg(F.min("id").alias("component"))
    placed = settle(ids.join(smallest, "label").select("s1", "s2", "n", "component"), "placed")
    found = attach(rows, placed, {"s1": "s1", "s2": "s2", "n": "n"})
    return found.select("doc_id", F.col("n").alias("n_shingles"),
                       F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80, share: int = 4) -> DataFrame:
    """One row of each group of near-duplicates, with its own columns: the one of the smallest id, nulls last.

    Of several texts with that id the one with the smallest hash stays, and of repeated rows (same id, same text) the
    one whose columns have the smallest hash. All documents without words stay.
    """
    sketch = _sketch(docs, k, percent, share)
    rows = settle(sketch.frame.select("doc_id", "n", "s1", "s2", "th"), "rows").frame
    placed = settle(_labelled(docs, sketch, k, percent, share).select("s1", "s2", "n", "label"), "placed")
    found = attach(rows.filter("n > 0"), placed, {"s1": "s1", "s2": "s2", "n": "n"})
    # An id and a text stand for a row; how often they are there is counted along.
    counted = found.groupBy("label", "doc_id", "th").agg(F.count(F.lit(1)).alias("copies"))
    first = counted.groupBy("label").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), "doc_id", "th", "copies")).alias("first"))
    wordless = rows.filter("n = 0").select("doc_id", "th", F.lit(1).cast("long").alias("copies")).distinct()
    kept = settle(first.select("first.doc_id", "first.th", "first.copies").union(wordless), "kept").frame
    marked = docs.withColumn("__th", F.xxhash64("text"))

    def matching(choice: DataFrame) -> DataFrame:
        keys = choice.select(F.col("doc_id").alias("__keep"), F.col("th").alias("__keep_th"))
        return attach(marked, keys, {"doc_id": "__keep", "__th": "__keep_th"}, how="left_semi")

    single = matching(kept.filter("copies = 1")).drop("__th")
    several = kept.filter("copies > 1")
    if several.isEmpty():
        return single
    plain = [f"`{f.name}`" for f in docs.schema.fields if isinstance(f.dataType, AtomicType)]
    chosen = matching(several).groupBy("doc_id", "__th").agg(F.min_by(
        F.struct(*[f"`{c}`" for c in docs.columns]), F.xxhash64(*plain)).alias("__row"))
    return single.union(chosen.select("__row.*"))

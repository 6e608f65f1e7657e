"""Language identification by rank-order profiles of character n-grams.

A profile is the list of the ``PROFILE`` most frequent n-grams (one to ``LONGEST`` characters) of a language, learned
from labelled texts. A text's own list is held against each profile: each of its n-grams adds the difference of its two
ranks, or ``PROFILE`` where the profile lacks it, and the language with the smallest sum wins.

Letters are those of Unicode, in lower case; words are runs of letters with a space on either side, and no n-gram
reaches over a word. Ties of frequency go to the smaller n-gram by code points, ties of distance to the smaller name.
An n-gram is held as one exact number. Learning is one pass whose tasks send partial counts, summed in Spark; what is
broadcast is the profiles, at most ``PROFILE`` numbers for each of at most ``MAX_LANGUAGES`` label values (more are an
error). Prediction is a second pass without a shuffle; it reads the text and nothing else.

Defined cases: a text that is null or has no letter is ``und`` with score 0, as is every text when nothing could be
learned; repeated rows are learned from and predicted each by itself; rows without a label are predicted only; a null
id is not held out; an empty table gives no rows; a very long text is counted in pieces, whole; further columns of any
name are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm import ship

ship(__name__)

PROFILE = 300
LONGEST = 3
MAX_LANGUAGES = 10_000
UNKNOWN = "und"
# N-grams that a task holds between two partial counts.
HELD = 2_000_000
# Texts are worked on in pieces of so many characters.
PIECE = 1 << 20
# Characters of a gram lie in 21 bits each, the first one highest.
BITS = 21
SPACE = 32


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def _counted(grams: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams in ascending order, and how often each occurs (or the sums of ``counts``)."""
    if counts is None:
        grams = np.sort(grams)
    else:
        order = np.argsort(grams, kind="stable")
        grams, counts = grams[order], counts[order]
    first = np.flatnonzero(np.append(True, grams[1:] != grams[:-1])) if len(grams) else np.zeros(0, np.int64)
    if counts is None:
        return grams[first], np.diff(np.append(first, len(grams)))
    return grams[first], np.add.reduceat(counts, first) if len(first) else counts


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a text as numbers, ascending, and their counts."""
    text, letters = (text or "").lower(), _letters()
    parts, held = [], np.array([SPACE])
    for at in range(0, len(text), PIECE):
        codes = np.frombuffer(text[at:at + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)
        last = at + PIECE >= len(text)
        row = np.concatenate([held, np.where(letters[codes], codes, SPACE), [SPACE] * last]).astype(np.int64)
        # One space between two words; the last characters wait for what follows them.
        row = row[np.append(True, (row[1:] != SPACE) | (row[:-1] != SPACE))]
        held = row[-(LONGEST - 1):]
        begins = len(row) if last else max(len(row) - LONGEST + 1, 0)
        inner = row != SPACE
        grams = [(row[:begins] << (2 * BITS))[inner[:begins]]]
        n = min(begins, len(row) - 1)
        grams.append((row[:n] << (2 * BITS)) + (row[1:n + 1] << BITS))
        n = min(begins, len(row) - 2)
        if n > 0:
            grams.append(((row[:n] << (2 * BITS)) + (row[1:n + 1] << BITS) + row[2:n + 2])[inner[1:n + 1]])
        parts.append(_counted(np.concatenate(grams)))
    if len(parts) == 1:
        return parts[0]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return _counted(*(np.concatenate(lists) for lists in zip(*parts)))


def _top(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The most frequent n-grams, the smaller ones first among equals."""
    if len(counts) > PROFILE:
        good = counts >= np.partition(counts, -PROFILE)[-PROFILE]
        grams, counts = grams[good], counts[good]
    return grams[np.argsort(-counts, kind="stable")[:PROFILE]]


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list] = {}

    def sent() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            found, counts = _counted(*(np.concatenate(lists) for lists in zip(*parts)))
            yield pa.record_batch([pa.array([lang] * len(found), pa.string()), pa.array(found), pa.array(counts)],
                                  ["lang", "gram", "n"])
        held.clear()

    size = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang"), batch.column("text")):
            found = gram_counts(text.as_py())
            held.setdefault(lang.as_py(), []).append(found)
            size += len(found[0])
            if size >= HELD:
                yield from sent()
                size = 0
    yield from sent()


def profiles(labelled: DataFrame) -> DataFrame:
    """lang, rank (from 0) and gram of the most frequent n-grams, from rows with text and lang."""
    counts = (labelled.filter("text is not null and lang is not null").select("lang", "text")
              .mapInArrow(_partial_counts, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return (counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= PROFILE)
            .select("lang", (F.col("rank") - 1).alias("rank"), "gram"))


class Ranker:
    """The out-of-place distances of a text to all profiles."""

    def __init__(self, names: list[str], lang: np.ndarray, rank: np.ndarray, gram: np.ndarray):
        order = np.argsort(gram, kind="stable")
        self._names, self._lang, self._rank = names, lang[order], rank[order]
        self._grams, self._start, self._size = np.unique(gram[order], return_index=True, return_counts=True)

    def predict(self, text: str | None) -> tuple[str, float]:
        top = _top(*gram_counts(text))
        if not len(top) or not self._names:
            return UNKNOWN, 0.0
        place = np.minimum(np.searchsorted(self._grams, top), len(self._grams) - 1)
        own = np.flatnonzero(self._grams[place] == top)
        place = place[own]
        size = self._size[place]
        # Every line of the profiles that holds one of the text's n-grams.
        first = np.repeat(self._start[place] - np.cumsum(size) + size, size)
        lines = first + np.arange(len(first))
        gained = PROFILE - np.abs(np.repeat(own, size) - self._rank[lines])
        most = PROFILE * len(top)
        distance = most - np.bincount(self._lang[lines], gained, minlength=len(self._names))
        best = int(np.argmin(distance))
        return self._names[best], 1.0 - float(distance[best]) / most


def identify(docs: DataFrame, learn_from: Column, text: str = "text", lang: str = "lang") -> DataFrame:
    """Adds lang_pred and score to the rows of ``docs``; profiles come from the rows where ``learn_from`` holds."""
    labelled = docs.filter(learn_from).select(F.col(f"`{lang}`").cast("string").alias("lang"),
                                              F.col(f"`{text}`").alias("text"))
    lines = profiles(labelled).limit(PROFILE * MAX_LANGUAGES + 1).collect()
    # Spark orders text by its bytes, which is the order of code points, as Python's is.
    names = sorted({line["lang"] for line in lines})
    if len(lines) > PROFILE * MAX_LANGUAGES or len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} different labels")
    number = {name: i for i, name in enumerate(names)}
    learned = (names, np.array([number[line["lang"]] for line in lines], np.int64),
               np.array([line["rank"] for line in lines], np.int64), np.array([line["gram"] for line in lines], np.int64))
    shared = docs.sparkSession.sparkContext.broadcast(learned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker = Ranker(*shared.value)
        for batch in batches:
            found = [ranker.predict(t.as_py()) for t in batch.column("__text")]
            yield pa.record_batch([*(batch.column(c) for c in batch.schema.names if c != "__text"),
                                   pa.array([f[0] for f in found], pa.string()),
                                   pa.array([f[1] for f in found], pa.float64())],
                                  [*(c for c in batch.schema.names if c != "__text"), "lang_pred", "score"])

    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score", text.lower(), "__text")]
    rows = docs.select(*[f"`{c}`" for c in kept], F.col(f"`{text}`").alias("__text"))
    schema = rows.drop("__text").schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(run, schema)


def split_by_id(docs: DataFrame, doc_id: str = "doc_id") -> Column:
    """Whether a document is held out from learning: a checksum of its id decides."""
    return F.coalesce(F.pmod(F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))

"""Best-fit packing of tokenised documents into sequences of a fixed length.

Documents are tokenised in Arrow batches and cut into pieces where they are longer than a sequence. The pieces (narrow
rows, without the ids) are dealt to packers by a hash, in a fixed order. Each packer is a bounded-space online
best-fit: a fixed number of sequences is open, a bitset has one bit for every free space that some open sequence has,
and a piece goes to the sequence with the least free space that still holds it. When none holds it and all are open,
the fullest is closed. A packer holds ``OPEN_BINS`` sequences and nothing else, so its memory does not grow.

The tokenizer drops white space and never joins across it, so a text is tokenised chunk by chunk between white space
and the ids of short chunks are remembered (``REMEMBERED`` at most); the result is that of the whole text. Chunks that
may hold a special token go to the tokenizer whole.

Defined cases: a null or empty text is the one id 0; equal rows are packed each by itself; an empty table gives no
rows; the input may have further columns of any name; a very long text is held by one task, with its ids as bytes. Bytes that are not UTF-8 are replaced before tokenising.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import ship
from shelfwise.llm.common import shuffle_partitions
from shelfwise.operators.materialise import settle

ship(__name__)

SEQUENCE = 2048
OPEN_BINS = 1024
END_ID = 0
TOKENIZER = "word_bpe_49k.json"
REMEMBERED = 600_000
# ASCII punctuation but for the apostrophe, which can begin a contraction.
ENDINGS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# A packer closes its open sequences at the end, so it should fill many: about this many tokens each.
PACKER_TOKENS = 4_000_000
ID_BYTES = 4
# The names of special tokens begin with this.
SPECIAL = b"<|"
# Letters that no normalisation changes.
LETTERS = re.compile("[a-zß-öø-ÿ]+")
SEQUENCE_STRIDE = 1 << 40

PIECES = "piece int, start long, length long, ids_crc32 long"


class ChunkIds(dict):
    """Ids of chunks as little-endian bytes; the first use of a chunk runs the tokenizer.

    The tokenizer lower-cases and always parts letters and digits from punctuation, so case is dropped beforehand and
    the punctuation at the end of a chunk is looked up by itself: ``word,`` and ``Word`` are known once ``word`` is.
    """

    def __init__(self, path: str | None):
        super().__init__()
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(TOKENIZER)
        self._tokenizer = Tokenizer.from_file(path)
        self._merge = self._tokenizer.model.tokenize
        # The printable character that stands for each byte in the vocabulary.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self._shown = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}

    def __missing__(self, chunk: bytes) -> bytes:
        core = chunk.rstrip(ENDINGS)
        text = chunk.decode("utf-8", "replace")
        if SPECIAL in chunk:
            # The name of a special token may lie anywhere in the chunk, its ending included.
            found = array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        elif LETTERS.fullmatch(text):
            # One run of plain letters: it goes to the merges as it is.
            spelt = chunk.decode("latin-1").translate(self._shown)
            found = array("I", [token.id for token in self._merge(spelt)]).tobytes()
        elif core and len(core) < len(chunk) and LETTERS.fullmatch(core.decode("utf-8", "replace")[-1]):
            found = self[core] + self[chunk[len(core):]]
        else:
            ids = self._tokenizer.encode(text, add_special_tokens=False).ids
            found = array("I", ids).tobytes()
        if len(chunk) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[chunk] = found
        return found

    def of(self, text: bytes | None) -> bytes:
        """The ids of a text and the end id."""
        text = text or b""
        # The names of special tokens are told apart by case.
        chunks = (text if SPECIAL in text else text.lower()).split()
        return b"".join(map(self.__getitem__, chunks)) + array("I", [END_ID]).tobytes()


def _cut(path: str | None, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ChunkIds(path)
        step = size * ID_BYTES
        for batch in batches:
            rows, piece, start, length, crc = [], [], [], [], []
            for row, text in enumerate(batch.column("__text")):
                ids = known.of(text.as_py())
                for number, at in enumerate(range(0, len(ids), step)):
                    part = ids[at:at + step]
                    rows.append(row)
                    piece.append(number)
                    start.append(at // ID_BYTES)
                    length.append(len(part) // ID_BYTES)
                    crc.append(zlib.crc32(part))
            yield pa.record_batch(
                [batch.column("doc_id").take(pa.array(rows, pa.int32())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def pieces(docs: DataFrame, tokenizer_path: str | None = None, size: int = SEQUENCE) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", F.col("text").cast("binary").alias("__text"))
    return source.mapInArrow(_cut(tokenizer_path, size), f"doc_id {kind}, {PIECES}")


class Packer:
    """Bounded-space best-fit. ``place`` gives the sequence number and the offset of a piece."""

    def __init__(self, size: int = SEQUENCE, open_bins: int = OPEN_BINS):
        self._size, self._limit = size, open_bins
        self._free = 0  # bit f is set when an open sequence has f free places
        self._by_free: dict[int, list[int]] = {}
        self._open = 0
        self._made = 0

    def _take(self, free: int) -> int:
        stack = self._by_free[free]
        number = stack.pop()
        self._open -= 1
        if not stack:
            del self._by_free[free]
            self._free ^= 1 << free
        return number

    def place(self, length: int) -> tuple[int, int]:
        fitting = self._free >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self._open >= self._limit:
                self._take((self._free & -self._free).bit_length() - 1)
            free, number = self._size, self._made
            self._made += 1
        left = free - length
        if left:
            self._by_free.setdefault(left, []).append(number)
            self._free |= 1 << left
            self._open += 1
        return number, self._size - free


def _pack(size: int, open_bins: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, base = Packer(size, open_bins), None
        for batch in batches:
            if base is None and batch.num_rows:
                base = batch.column("__packer")[0].as_py() * SEQUENCE_STRIDE
            placed = [packer.place(n) for n in batch.column("length").to_pylist()]
            keep = [name for name in batch.schema.names if name != "__packer"]
            yield pa.record_batch(
                [*[batch.column(name) for name in keep], pa.array([base + n for n, _ in placed], pa.int64()),
                 pa.array([at for _, at in placed], pa.int64())], [*keep, "sequence_id", "offset"])

    return run


def pack(parts: DataFrame, size: int = SEQUENCE, open_bins: int = OPEN_BINS) -> DataFrame:
    """Place written ``parts`` (doc_id, piece, start, length, ids_crc32): adds sequence_id and offset."""
    total = parts.agg(F.sum("length").alias("n")).first()["n"] or 0
    packers = max(1, min(total // PACKER_TOKENS, shuffle_partitions(parts.sparkSession)))
    kind = parts.schema["doc_id"].dataType.simpleString()
    order = ["__order", "doc_id", "piece"]
    # Equal rows differ by the part of the written table they lie in, so copies of one row reach many packers.
    dealt = (
        parts.withColumn("__order", F.xxhash64("doc_id", "piece", "ids_crc32", F.spark_partition_id()))
        .repartition(packers, "__order").sortWithinPartitions(*order)
        .withColumn("__packer", F.spark_partition_id()).drop("__order"))
    return dealt.mapInArrow(_pack(size, open_bins), f"doc_id {kind}, {PIECES}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, size: int = SEQUENCE,
                   open_bins: int = OPEN_BINS) -> DataFrame:
    """Tokenise, cut and pack; the pieces are written once in between."""
    return pack(settle(pieces(docs, tokenizer_path, size), "pieces").frame, size, open_bins)

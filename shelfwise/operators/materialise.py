"""Write an intermediate result once, in the shared folder, and know its size."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A table is broadcast only when both bounds hold; the bytes are those of the decoded rows.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 128 * 1024 * 1024
# Files up to this size are always cheap enough to measure.
SMALL_FILE = 1024 * 1024

DIR_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach. Only a local session may fall back to a temporary one."""
    named = spark.conf.get(DIR_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {DIR_SETTING} to a folder that all executors can reach")
        named = tempfile.mkdtemp(prefix="shelfwise-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def _located(spark: SparkSession, name: str):
    """The file system and path object of a name."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


_RUN_FOLDER: ContextVar[str | None] = ContextVar("run_folder", default=None)


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{_RUN_FOLDER.get() or shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for the steps of one run, deleted at its end, also after an error. Frames that read a step must have
    been written out by then. Inside another run its folder is used."""
    outer = _RUN_FOLDER.get()
    if outer is not None:
        yield outer
        return
    folder = fresh_path(spark, "run")
    mark = _RUN_FOLDER.set(folder)
    try:
        yield folder
    finally:
        _RUN_FOLDER.reset(mark)
        system, path = _located(spark, folder)
        system.delete(path, True)


def _row_bytes(schema: T.StructType) -> str:
    """SQL for the decoded size of a row: text by its bytes, nested values by their JSON, others 16 bytes."""
    parts = ["0"]
    for field in schema.fields:
        c = f"`{field.name}`"
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            parts.append(f"coalesce(octet_length({c}), 0) + 16")
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(f"octet_length(to_json(struct({c}))) + 32")
        else:
            parts.append("16")
    return " + ".join(parts)


def spread(rows: DataFrame) -> DataFrame:
    """Deal narrow rows to all tasks before much work is done on each: the files of a table may be so small, or so few,
    that one task reads most of it. Goes by the whole row, so that a repeated task deals them alike."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, *[f"`{c}`" for c in rows.columns])


class Settled:
    """A written table. Its size is measured when first asked for."""

    def __init__(self, frame: DataFrame, path: str):
        self.frame = frame
        self.path = path
        self._parent: Settled | None = None
        self._measured: tuple[int, int] | None = None

    def narrowed(self, frame: DataFrame) -> Settled:
        """A part of this table (fewer rows or columns), bounded by the size of the whole."""
        part = Settled(frame, self.path)
        part._parent = self
        return part

    def parts(self, column: str) -> dict[str, Settled]:
        """The rows of each value of a short text column, each part with its own size; one pass measures all."""
        sizes = self.frame.groupBy(column).agg(F.count(F.lit(1)).alias("n"), F.sum(F.expr(
            f"cast({_row_bytes(self.frame.schema)} as long)")).alias("size")).collect()
        found = {}
        for line in sizes:
            part = Settled(self.frame.filter(F.col(column).eqNullSafe(line[column])), self.path)
            part._measured = (line["n"], line["size"] or 0)
            found[line[column]] = part
        return found

    def bytes_on_disk(self) -> int:
        system, path = _located(self.frame.sparkSession, self.path)
        return system.getContentSummary(path).getLength()

    def delete(self) -> None:
        """Delete the files of a step that nothing reads any more."""
        system, path = _located(self.frame.sparkSession, self.path)
        system.delete(path, True)

    def measure(self) -> tuple[int, int]:
        """(rows, decoded bytes)."""
        if self._parent is not None:
            return self._parent.measure()
        if self._measured is None:
            line = self.frame.selectExpr("count(1) as n", f"sum(cast({_row_bytes(self.frame.schema)} as long)) as size")
            found = line.first()
            self._measured = (found["n"], found["size"] or 0)
        return self._measured

    def fits(self, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
        """Whether the table may be broadcast. Large files are refused unread."""
        max_rows = BROADCAST_ROWS if max_rows is None else max_rows
        max_bytes = BROADCAST_BYTES if max_bytes is None else max_bytes
        known = self._measured is not None or (self._parent is not None and self._parent._measured is not None)
        if not known and self.bytes_on_disk() > max(max_bytes, SMALL_FILE):
            return False
        rows, size = self.measure()
        return rows <= max_rows and size <= max_bytes


def settle(df: DataFrame, label: str = "step") -> Settled:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return Settled(spark.read.schema(df.schema).parquet(path), path)

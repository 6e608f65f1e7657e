"""Logs of runs that stay cheap as they grow.

A log is partitioned by a hash of the run id. A round of runs lists and reads only the buckets that its ids fall into, so the
files read grow with the round and not with the log. Within a bucket, files are sorted by id and carry a Bloom filter of
their ids; rounds of a few ids are pushed into the scan, which then skips the row groups that cannot hold them.

Each round adds one file to each bucket it touches; ``compact_log`` makes them one file a bucket again. A log that was
begun without buckets is read whole and stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.sources.tables import (
    append_rows, folder_of, is_path, located, names_in, read_table, replace_folder,
)

BUCKET = "id_bucket"
# Fixed for all logs: another number would look for ids in the wrong buckets.
LOG_BUCKETS = 256
# Up to so many ids are given to the scan as values (the limit from which on Spark itself passes only a range).
FEW_IDS = 10
BLOOM = {"parquet.bloom.filter.enabled#id": "true", "parquet.bloom.filter.expected.ndv#id": "10000"}


def _logged_id() -> Column:
    """The id as logs hold it: empty where there is none."""
    return F.coalesce(F.col("id").cast("string"), F.lit(""))


def id_bucket() -> Column:
    return F.pmod(F.xxhash64(_logged_id()), F.lit(LOG_BUCKETS)).cast("int")


def open_log(spark: SparkSession, name: str, schema: str) -> None:
    """Create the log, in buckets, unless it exists."""
    if not is_path(name):
        if not spark.catalog.tableExists(name):
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}, {BUCKET} int) USING parquet "
                      f"PARTITIONED BY ({BUCKET})")
    elif folder_of(spark, name) is None:
        system, mark = located(spark, f"{name.rstrip('/')}/_SUCCESS")
        system.createNewFile(mark)


def _in_buckets(spark: SparkSession, name: str) -> bool:
    if not is_path(name):
        return BUCKET in spark.table(name).columns
    held = [n for n in names_in(spark, folder_of(spark, name) or name) if not n.startswith(("_", "."))]
    return all(n.startswith(f"{BUCKET}=") for n in held)


def read_log(spark: SparkSession, name: str, schema: str) -> DataFrame:
    """The whole log, with its buckets if it has any."""
    if is_path(name) and _in_buckets(spark, name):
        return spark.read.schema(f"{schema}, {BUCKET} int").parquet(folder_of(spark, name) or name)
    return read_table(spark, name)


def log_of(ids: DataFrame, name: str, schema: str) -> DataFrame:
    """The lines of the log that may be about these ids (a column ``id``): those of their buckets.

    ``ids`` is read twice. No more than one number a bucket and a few ids pass through the driver.
    """
    spark = ids.sparkSession
    if not _in_buckets(spark, name):
        return read_table(spark, name)
    buckets = sorted(r["b"] for r in ids.select(id_bucket().alias("b")).distinct().collect())
    if is_path(name):
        # Only the folders of these buckets are listed.
        folder = folder_of(spark, name) or name
        held = set(names_in(spark, folder))
        wanted = [f"{folder}/{BUCKET}={b}" for b in buckets if f"{BUCKET}={b}" in held]
        if not wanted:
            return spark.createDataFrame([], f"{schema}, {BUCKET} int")
        log = spark.read.schema(f"{schema}, {BUCKET} int").option("basePath", folder).parquet(*wanted)
    else:
        log = spark.table(name)
    part = log.filter(F.col(BUCKET).isin(buckets))
    few = [r["id"] for r in ids.select(_logged_id().alias("id")).distinct().limit(FEW_IDS + 1).collect()]
    return part.filter(F.col("id").isin(few)) if len(few) <= FEW_IDS else part


def append_log(rows: DataFrame, name: str) -> None:
    """Append lines, one file to each bucket that they fall into."""
    spark = rows.sparkSession
    if not _in_buckets(spark, name):
        append_rows(rows, name)
        return
    lines = _by_bucket(rows.withColumn(BUCKET, id_bucket()))
    if is_path(name):
        lines.write.mode("append").options(**BLOOM).partitionBy(BUCKET).parquet(folder_of(spark, name) or name)
    else:
        lines.write.format("parquet").mode("append").options(**BLOOM).partitionBy(BUCKET).saveAsTable(name)


def _by_bucket(lines: DataFrame) -> DataFrame:
    return lines.repartition(BUCKET).sortWithinPartitions(BUCKET, "id")


def compact_log(spark: SparkSession, name: str, schema: str) -> None:
    """Write a log under a path anew, one file a bucket; readers see the old log or the new one."""
    if not is_path(name) or not _in_buckets(spark, name):
        raise ValueError(f"{name} is no log in buckets under a path")
    replace_folder(_by_bucket(read_log(spark, name, schema)), name.rstrip("/"), [BUCKET], BLOOM)

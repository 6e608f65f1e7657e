"""Read and write tables, CSV, JSON lines and text.

A table under a path is a plain parquet folder, moved into place whole, until it is first replaced. From then on each state of it is a folder
``_versions/v<n>``, and an empty file ``_versions/ok<n>``, which appears in one step, says that it is complete: the
highest one is the table. A write that dies at any point leaves the state before it; the next one clears what is left.
There is no moment without a table. One writer at a time; read and append by the functions here.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shelfwise.operators.numbering import number_in_order

CORRUPT = "_corrupt_record"


def is_path(name: str) -> bool:
    return "/" in name


def located(spark: SparkSession, name: str):
    """The file system and path object of a name."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def names_in(spark: SparkSession, folder: str) -> list[str]:
    system, path = located(spark, folder)
    return [line.getPath().getName() for line in system.listStatus(path)] if system.exists(path) else []


def _numbers(names: Sequence[str], prefix: str) -> list[int]:
    return [int(m.group(1)) for m in (re.fullmatch(prefix + r"(\d+)", n) for n in names) if m]


def folder_of(spark: SparkSession, path: str) -> str | None:
    """The folder that holds the table of this path now; None if there is no table."""
    path = path.rstrip("/")
    complete = _numbers(names_in(spark, f"{path}/_versions"), "ok")
    if complete:
        return f"{path}/_versions/v{max(complete)}"
    held = names_in(spark, path)
    return path if "_SUCCESS" in held or any(not n.startswith(("_", ".")) for n in held) else None


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalogue table by name, or a parquet table by path."""
    if not is_path(name):
        _finish_renames(spark, name)
        return spark.table(name)
    return spark.read.parquet(folder_of(spark, name) or name)


def read_csv(spark: SparkSession, path: str, schema: StructType | str, keep_corrupt: bool = False) -> DataFrame:
    """CSV with a header. Short lines are filled with nulls; ``keep_corrupt`` reports them in ``_corrupt_record``."""
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if keep_corrupt:
        wanted = StructType([*wanted.fields, StructField(CORRUPT, StringType())])
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", True)
    return reader.option("columnNameOfCorruptRecord", CORRUPT).schema(wanted).csv(path)


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str = "lang string, word string",
                    ) -> DataFrame:
    """JSON lines; only the fields of the schema are parsed out."""
    return spark.read.schema(schema).json(path)


def concat_sources(sources: Sequence[DataFrame], rank: str | None = None) -> DataFrame:
    """All rows of all sources by column name; ``rank`` adds the position of the source."""
    ranked = [s.withColumn(rank, F.lit(i)) if rank else s for i, s in enumerate(sources)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)


def tag_split(train: DataFrame | None, test: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Both frames with a ``split`` column; a missing one is replaced by the other."""
    if train is None and test is None:
        raise ValueError("give a training frame, a test frame or both")
    train = test if train is None else train
    test = train if test is None else test
    return train.withColumn("split", F.lit("train")), test.withColumn("split", F.lit("test"))


def cast_to(df: DataFrame, schema: StructType | str) -> DataFrame:
    """Exactly the columns and types of the schema."""
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in wanted.fields])


def write_table(df: DataFrame, name: str, schema: StructType | str | None = None) -> None:
    """Replace the table. The frame may read the very table it replaces: it is written beside it first.

    Whatever happens in between, the table is there, old or new. Only a catalogue table that changes its columns, is
    partitioned or external has a short moment between two renames; the next read or write of it finishes them.
    """
    if schema is not None:
        df = cast_to(df, schema)
    if is_path(name):
        replace_folder(df, name.rstrip("/"))
    else:
        _replace_catalogue_table(df, name)


def replace_folder(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                   options: Mapping[str, str] | None = None) -> None:
    """Replace the table under this path in one step."""
    spark = df.sparkSession
    writer = df.write.options(**(options or {})).partitionBy(*partition_by)
    system, place = located(spark, path)
    if not system.exists(place):
        staging = f"{path}__new_{uuid.uuid4().hex}"
        writer.parquet(staging)
        if not system.rename(located(spark, staging)[1], place):
            raise OSError(f"cannot move {staging} into place")
        return
    versions = f"{path}/_versions"
    held = names_in(spark, versions)
    number = max([0, *_numbers(held, "v"), *_numbers(held, "ok")]) + 1
    writer.parquet(f"{versions}/v{number}")
    _complete(spark, versions, number)
    _clear(spark, path, number)
    spark.catalog.refreshByPath(path)


def _complete(spark: SparkSession, versions: str, number: int) -> None:
    """Make this version the table. A second writer of the same version fails here."""
    system, mark = located(spark, f"{versions}/ok{number}")
    if not system.createNewFile(mark):
        raise OSError(f"{versions} is written by someone else")


def _clear(spark: SparkSession, path: str, number: int) -> None:
    """Delete all that is not this version: states before it, and parts of writes that died."""
    for folder, kept in ((f"{path}/_versions", {f"v{number}", f"ok{number}"}), (path, {"_versions"})):
        for name in names_in(spark, folder):
            if name not in kept:
                system, left = located(spark, f"{folder}/{name}")
                system.delete(left, True)


def _replace_catalogue_table(df: DataFrame, name: str) -> None:
    spark = df.sparkSession
    _finish_renames(spark, name)
    if not spark.catalog.tableExists(name):
        df.write.format("parquet").saveAsTable(name)
        return
    facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    mark = uuid.uuid4().hex
    same = [(f.name, f.dataType) for f in spark.table(name).schema] == [(f.name, f.dataType) for f in df.schema]
    if same and facts.get("Type") == "MANAGED" and facts.get("Provider") == "parquet" and (
            "# Partition Information" not in facts):
        old = facts["Location"]
        new = f"{re.sub('__v_[0-9a-f]{32}$', '', old)}__v_{mark}"
        df.write.parquet(new)
        # One entry of the catalogue changes, in one step.
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{new}'")
        spark.catalog.refreshTable(name)
        system, left = located(spark, old)
        system.delete(left, True)
        return
    df.write.format("parquet").saveAsTable(f"{name}__new_{mark}")
    # The rows are written once; the two tables then change names.
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__old_{mark}")
    _finish_renames(spark, name)


def _finish_renames(spark: SparkSession, name: str) -> None:
    """Put the new table in the place of one that was moved aside."""
    if spark.catalog.tableExists(name):
        return
    *space, short = name.split(".")
    listed = spark.sql("SHOW TABLES" + (f" IN {'.'.join(space)}" if space else "")).collect()
    names = {r["tableName"] for r in listed if not r["isTemporary"]}
    for mark in (n.removeprefix(f"{short}__old_") for n in names if n.startswith(f"{short}__old_")):
        full = ".".join([*space, short])
        # The new table was whole before the old one was moved.
        if f"{short}__new_{mark}" in names:
            spark.sql(f"ALTER TABLE {full}__new_{mark} RENAME TO {full}")
            spark.sql(f"DROP TABLE {full}__old_{mark}")
            return


def create_if_absent(spark: SparkSession, name: str, schema: str) -> bool:
    """Create an empty table unless it exists; tells whether it did create one."""
    if is_path(name):
        if folder_of(spark, name) is not None:
            return False
        # Left without a table by a write that died, the folder may exist.
        spark.createDataFrame([], schema).write.mode("append").parquet(name)
        return True
    _finish_renames(spark, name)
    if spark.catalog.tableExists(name):
        return False
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet")
    return True


def append_rows(df: DataFrame, name: str) -> None:
    """Append all rows in one write."""
    if is_path(name):
        df.write.mode("append").parquet(folder_of(df.sparkSession, name) or name)
    else:
        df.write.format("parquet").mode("append").saveAsTable(name)


def write_word_list(counts: DataFrame, path: str, word: str = "word", count: str = "freq") -> None:
    """Text lines ``word count``."""
    counts.select(F.concat_ws(" ", word, F.col(count).cast("string"))).write.mode("overwrite").text(path)


def write_csv_with_index(df: DataFrame, path: str, order: Sequence[str], index: str = "index") -> None:
    """CSV with a header and a leading row number from 0 in the given (total) order."""
    numbered = number_in_order(df.withColumn("__all", F.lit(0)), "__all", order, index, first=0).drop("__all")
    numbered.select(index, *df.columns).write.mode("overwrite").option("header", True).csv(path)

"""Cleaning, repair, text and word queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise import constants as C
from shelfwise.functions import text
from shelfwise.operators.clean import clean_frame, left_over_missing_brands, repair_cells, repair_cells_from
from shelfwise.operators.materialise import fresh_path
from shelfwise.operators.words import word_frequency
from shelfwise.sources.tables import (
    append_rows, create_if_absent, read_csv, read_json_lines, read_table, write_csv_with_index, write_table,
    write_word_list,
)
from workload.base import (
    MISSING, branded, branded_sql, clean_sql, cleaned, cleaned_sql, products, quoted, table,
)

WORDS = r"[ \t\n\f\r]+"


def _nations(spark, sf):
    joined = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return clean_frame(joined.select("n_nationkey", F.lower("n_name").alias("n_name"),
                                     F.concat(F.lit(" "), "r_name").alias("r_name")))


# Cells as they come out of a wrong decoding: some known to the dictionary, some not.
DAMAGED = """
select p_partkey as id, p_name as name,
  case p_partkey % 7 when 0 then 'Misi?n' when 1 then 'Zo?polis' when 2 then concat(p_name, '?') when 3 then 'Acci?n'
       when 4 then 'es C?nclave' when 5 then null else p_name end as title
from {part}
"""


def _damaged(spark, sf):
    return spark.sql(DAMAGED, part=table(spark, sf, "part"))


def _word_entries(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("lang", F.explode(F.split("text", WORDS)).alias("word"))


def _json_words(spark, sf):
    path = fresh_path(spark, "dictionary")
    _word_entries(spark, sf).write.json(path)
    return word_frequency(read_json_lines(spark, path), "fr")


def _word_list(spark, sf):
    path = fresh_path(spark, "words")
    write_word_list(word_frequency(_word_entries(spark, sf), "fr"), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


def _csv_round_trip(spark, sf):
    path = fresh_path(spark, "csv")
    rows = cleaned(spark, sf)
    rows.write.option("header", True).csv(path)
    return read_csv(spark, path, rows.schema)


def _csv_with_index(spark, sf):
    path = fresh_path(spark, "indexed")
    customers = table(spark, sf, "customer")
    write_csv_with_index(customers, path, ["c_mktsegment", "c_custkey"])
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in customers.schema.fields)
    return read_csv(spark, path, f"index long, {fields}")


def _replaced_table(spark, sf):
    path = fresh_path(spark, "table")
    write_table(products(spark, sf), path)
    current = read_table(spark, path)
    write_table(clean_frame(current), path, current.schema)  # reads the table it replaces
    return read_table(spark, path)


def _appended_log(spark, sf):
    path = fresh_path(spark, "log")
    create_if_absent(spark, path, "id string, status string")
    orders = table(spark, sf, "orders")
    for status in ("F", "O", "P"):
        append_rows(orders.filter(F.col("o_orderstatus") == status).select(
            F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("status")), path)
    return read_table(spark, path)


def _missing_brands(spark, sf):
    """How many "no brand" words there are before and after they are turned into nulls."""
    before, after = left_over_missing_brands(cleaned(spark, sf)), left_over_missing_brands(branded(spark, sf))
    return before.withColumn("step", F.lit("before")).unionByName(after.withColumn("step", F.lit("after")))


# A dictionary of damaged product names, with two repairs for some, and cells of which some are damaged.
REPAIRS = """select replace(p_name, ' ', '?') as damaged, concat(upper(p_name), ' ', p_brand) as repaired from {part}
  where p_partkey % 3 <> 0 union all select p_name, 'NOT DAMAGED' from {part}"""
CELLS = """select p_partkey, case when p_partkey % 2 = 0 then replace(p_name, ' ', '?') else p_name end as title,
  case when p_partkey % 5 = 0 then concat(p_type, '?') else replace(p_name, ' ', '?') end as label from {part}"""


def _repaired(spark, sf):
    part = table(spark, sf, "part")
    return repair_cells_from(spark.sql(CELLS, part=part), spark.sql(REPAIRS, part=part))


QUERIES = {
    "clean_products": lambda s, d: clean_frame(products(s, d)),
    "clean_documents": lambda s, d: clean_frame(table(s, d, "documents")),
    "clean_regions": _nations,
    "null_brands": branded,
    "missing_brands_left": _missing_brands,
    "repair_cells": lambda s, d: repair_cells(_damaged(s, d)),
    "repair_cells_dictionary": _repaired,
    "describe_items": lambda s, d: cleaned(s, d, with_id=True).select(
        "row_id", text.describe(F.col("item_desc"), F.col("local_brand_name"), F.col("global_brand_name"))
        .alias("description")),
    "hierarchy_path": lambda s, d: cleaned(s, d, with_id=True).select(
        "row_id", text.level_path([F.col(c) for c in C.GLOBAL_LEVELS]).alias("path")),
    "word_frequency": lambda s, d: word_frequency(_word_entries(s, d), "fr"),
    "json_lines_words": _json_words,
    "word_list_text": _word_list,
    "csv_round_trip": _csv_round_trip,
    "csv_with_index": _csv_with_index,
    "replaced_table": _replaced_table,
    "appended_log": _appended_log,
}

_DOC_CLEAN = f"{clean_sql('text')} as text, {clean_sql('lang')} as lang, {clean_sql('source')} as source"
_FR_WORDS = ("select lower(w) as word, count(*) as freq from (select unnest(regexp_split_to_array(text, "
             "'[ \\t\\n\\f\\r]+')) as w from documents where lang = 'fr') where w <> '' group by 1")
_FIXES = " ".join(f"when {quoted([a])} then {quoted([b])}" for a, b in C.CELL_CORRECTIONS.items())
_FILLED_PATH = " || ' > ' || ".join(f"coalesce({c}, '')" for c in C.GLOBAL_LEVELS)

ORACLES = {
    "clean_products": f"{cleaned_sql()} select * from cl",
    "clean_documents": f"select doc_id, {_DOC_CLEAN}, n_chars from documents",
    "clean_regions": "select n_nationkey, upper(n_name) as n_name, r_name from nation "
                     "join region on n_regionkey = r_regionkey",
    "null_brands": f"{branded_sql()} select * from nb",
    "missing_brands_left": f"{branded_sql()} " + " union all ".join(
        f"select '{c}' as column_name, '{step}' as step, count(*) filter ({c} in ({MISSING})) as left_over from {rows}"
        for c in C.BRAND_COLUMNS for step, rows in (("before", "cl"), ("after", "nb"))),
    "repair_cells_dictionary": f"with fixes as (select damaged, min(repaired) as repaired from ("
        f"{REPAIRS.format(part='part')}) where contains(damaged, '?') group by 1), cells as ({CELLS.format(part='part')}) "
        "select p_partkey, coalesce(t.repaired, title) as title, coalesce(l.repaired, label) as label from cells "
        "left join fixes t on t.damaged = title left join fixes l on l.damaged = label",
    "repair_cells": "select id, name, case when contains(title, '?') then "
                    f"case title {_FIXES} else title end else title end as title "
                    f"from ({DAMAGED.replace('{part}', 'part')})",
    "describe_items": f"{cleaned_sql(True)} select row_id, coalesce('Description du produit: ' || item_desc || "
                      "'local_brand_name: ' || local_brand_name || ', global_brand_name: ' || global_brand_name, '') "
                      "as description from cl",
    "hierarchy_path": f"{cleaned_sql(True)} select row_id, {_FILLED_PATH} as path from cl",
    "word_frequency": _FR_WORDS,
    "json_lines_words": _FR_WORDS,
    "word_list_text": f"select word || ' ' || freq::varchar as line from ({_FR_WORDS})",
    "csv_round_trip": f"{cleaned_sql()} select * from cl",
    "csv_with_index": "select row_number() over (order by c_mktsegment, c_custkey) - 1 as index, * from customer",
    "replaced_table": f"{cleaned_sql()} select * from cl",
    "appended_log": "select o_orderkey::varchar as id, o_orderstatus as status from orders",
}

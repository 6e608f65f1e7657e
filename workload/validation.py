"""Rule, split, report and hierarchy queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from shelfwise.config import ALL_MEMBERS, SURPLUS, profile
from shelfwise.constants import GLOBAL_LEVELS, LOCAL_LEVELS
from shelfwise.operators import hierarchy as H
from shelfwise.operators import validate as V
from shelfwise.operators.materialise import fresh_path
from shelfwise.plans.cleaning import clean_and_validate, run_clean_and_validate
from workload.base import (
    DATASET, PRODUCT_COLUMNS, clean_table, cleaned, cleaned_sql, columns_sql, products, table,
)
from workload.brands import STANDARDISED_SQL

KEYS = list(DATASET.primary_keys)
LINE_KEYS = ["l_orderkey", "l_linenumber"]
SURPLUS_PROFILE = profile("supermarket", SURPLUS)
ALL_PROFILE = profile("supermarket", ALL_MEMBERS)

# Orders shipped to odd centuries, so that the year check on a typed date finds something.
SHIFTED = """select o_orderkey, cast(case when o_orderkey % 50 = 0 then o_orderdate - interval 60 year
    when o_orderkey % 77 = 0 then o_orderdate + interval 200 year else o_orderdate end as date) as o_day,
    o_orderstatus from {orders}"""


def _joined(flagged):
    return flagged.withColumn("error_reason", F.array_join("error_reason", ", "))


def _dup_rows(spark, sf):
    return _joined(V.flag_duplicate_rows(V.with_empty_reasons(clean_table(spark, sf)), PRODUCT_COLUMNS))


def _dup_keys(spark, sf):
    return _joined(V.flag_duplicate_keys(V.with_empty_reasons(clean_table(spark, sf)), KEYS))


def _dup_keys_lines(spark, sf):
    return _joined(V.flag_duplicate_keys(V.with_empty_reasons(table(spark, sf, "lineitem")), LINE_KEYS))


def _flagged(spark, sf):
    return clean_and_validate(products(spark, sf), DATASET, ALL_PROFILE)


def _excluded_table(spark, sf):
    """The whole plan from table to tables; the excluded table has the raw columns and the reason."""
    names = {name: fresh_path(spark, name) for name in ("raw", "clean", "excluded")}
    products(spark, sf).write.parquet(names["raw"])
    run_clean_and_validate(spark, replace(DATASET, **names), ALL_PROFILE)
    return spark.read.parquet(names["excluded"])


def _report(rows):
    return V.excluded_report(rows, DATASET, SURPLUS_PROFILE)


def _not_excluded(spark, sf):
    rows = clean_table(spark, sf)
    return V.without_excluded(rows, _report(rows))


def _texts(report, column):
    return report.withColumn(column, F.array_join(column, "|"))


def _hits(spark, sf):
    hits = V.rule_hits(clean_table(spark, sf), DATASET, SURPLUS_PROFILE.rules)
    return hits.groupBy("reason").agg(F.count(F.lit(1)).alias("distinct_rows"))


def _geography(spark, sf):
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    region = table(spark, sf, "region")
    rows = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey"))
    return _texts(H.hierarchy_warnings(rows, [("r_name", "n_name"), ("n_name", "c_mktsegment")]), "parents")


QUERIES = {
    "dup_rows_all": _dup_rows,
    "dup_rows_surplus": lambda s, d: V.surplus_duplicate_rows(clean_table(s, d), PRODUCT_COLUMNS),
    "dup_keys_all": _dup_keys,
    "dup_keys_surplus": lambda s, d: V.surplus_duplicate_keys(clean_table(s, d), KEYS),
    "dup_keys_lineitem": _dup_keys_lines,
    "dup_keys_surplus_lineitem": lambda s, d: V.surplus_duplicate_keys(table(s, d, "lineitem"), LINE_KEYS),
    "barcode_length": lambda s, d: _joined(V.flag_barcode_length(
        V.with_empty_reasons(products(s, d)), ["barcode", "size_desc"])),
    "barcode_length_sql": lambda s, d: V.barcode_length_rows(products(s, d), "barcode"),
    "date_format": lambda s, d: _joined(V.flag_dates(V.with_empty_reasons(cleaned(s, d)), ["non_active_date"])),
    "date_year_typed": lambda s, d: V.date_year_rows(s.sql(SHIFTED, orders=table(s, d, "orders"))),
    "excluded_table": _excluded_table,
    "validate_joined": lambda s, d: V.excluded_rows(_flagged(s, d)),
    "clean_split": lambda s, d: V.clean_rows(_flagged(s, d)),
    "rule_hits": _hits,
    "excluded_array": lambda s, d: _texts(_report(clean_table(s, d)), "reasons"),
    "clean_subtract": _not_excluded,
    "hierarchy_warnings": lambda s, d: _texts(H.hierarchy_warnings(cleaned(s, d)), "parents"),
    "inconsistent_children": lambda s, d: _texts(H.inconsistent_children(
        cleaned(s, d), "local_hierarchy_level2_desc", "local_hierarchy_level3_desc"),
        "Corresponding_local_hierarchy_level2_desc"),
    "hierarchy_geography": _geography,
    "hierarchy_conflicts": lambda s, d: H.hierarchy_conflicts(cleaned(s, d)),
    "hierarchy_summary": lambda s, d: _texts(H.hierarchy_summary(
        table(s, d, "customer"), [("c_name", "c_mktsegment")], listed=5), "first_parents"),
}

# ---- oracles ----------------------------------------------------------------------------------------------------

_ALL = columns_sql()
_ROW_DUP = f"count(*) over (partition by {_ALL}) > 1"
_KEY_DUP = "count(*) over (partition by country_id, barcode) > 1"
_ROW_N = f"row_number() over (partition by {_ALL}) > 1"


def _nulls_first(columns):
    return ", ".join(f"{c} nulls first" for c in columns)


_KEY_N = f"row_number() over (partition by country_id, barcode order by {_nulls_first(PRODUCT_COLUMNS)}) > 1"
_LINE_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                 "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
_BAD_CODE = "coalesce({c} <> '' and length({c}) not in (7, 8, 10, 13), false)"
_SHAPE = "'[0-9]{4}-(1[0-2]|0?[1-9])-(3[01]|[12][0-9]|0?[1-9]| [1-9])'"
_DAY = (f"case when regexp_full_match(non_active_date, {_SHAPE}) and not starts_with(non_active_date, '0000') "
        "then try_cast(replace(non_active_date, '- ', '-') as date) end")
_BAD_DATE = (f"coalesce(non_active_date <> '' and coalesce(year({_DAY}) <> 9999 and year({_DAY}) not between 1963 "
             "and 2100, true), false)")


def _reasons(*tests):
    return ("array_to_string(list_filter([" + ", ".join(
        f"case when {test} then '{name}' end" for test, name in tests) + "], lambda r: r is not null), ', ')")


_FOUR = _reasons((_ROW_DUP, "all_line_duplicate"), (_KEY_DUP, "primary_key_duplicate"),
                 (_BAD_CODE.format(c="barcode"), "wrong_barcode_length"), (_BAD_DATE, "wrong_date"))
_UNION = f""", hits as (
  select 'all_line_duplicate' as reason, * from cl qualify {_ROW_N}
  union all select 'primary_key_duplicate', * from cl qualify {_KEY_N}
  union all select 'wrong_barcode_length', * from cl where length(barcode) not in (7, 8, 10, 13)),
report as (select array_to_string(list_sort(array_agg(distinct reason)), '|') as reasons, {_ALL} from hits
  group by {_ALL})"""


def _level_lines(pairs, source):
    return " union all ".join(
        f"select '{down}' as child_level, '{up}' as parent_level, {down} as child_value, {up} as parent from {source}"
        for up, down in pairs)


def _warnings(pairs, source):
    lines = _level_lines(pairs, source)
    return ("select child_level, parent_level, child_value, array_to_string(list_sort(array_agg(distinct parent)), "
            f"'|') as parents from ({lines}) where parent is not null group by 1, 2, 3 "
            "having count(distinct parent) > 1")


_PAIRS = H.adjacent(GLOBAL_LEVELS) + H.adjacent(LOCAL_LEVELS)

ORACLES = {
    "dup_rows_all": f"{cleaned_sql()} select *, {_reasons((_ROW_DUP, 'all_line_duplicate'))} as error_reason from cl",
    "dup_rows_surplus": f"{cleaned_sql()} select * from cl qualify {_ROW_N}",
    "dup_keys_all": f"{cleaned_sql()} select *, {_reasons((_KEY_DUP, 'primary_key_duplicate'))} as error_reason "
                    "from cl",
    "dup_keys_surplus": f"{cleaned_sql()} select * from cl qualify {_KEY_N}",
    "dup_keys_lineitem": "select *, case when count(*) over (partition by l_orderkey, l_linenumber) > 1 then "
                         "'primary_key_duplicate' else '' end as error_reason from lineitem",
    "dup_keys_surplus_lineitem": "select * from lineitem qualify row_number() over (partition by l_orderkey, "
                                 f"l_linenumber order by {_nulls_first(_LINE_COLUMNS)}) > 1",
    "barcode_length": cleaned_sql().split(", cl as")[0] + " select *, " + _reasons(
        (_BAD_CODE.format(c="barcode"), "wrong_barcode_length"),
        (_BAD_CODE.format(c="size_desc"), "wrong_barcode_length")) + " as error_reason from products",
    "barcode_length_sql": cleaned_sql().split(", cl as")[0]
    + " select * from products where length(barcode) not in (7, 8, 10, 13)",
    "date_format": f"{cleaned_sql()} select *, {_reasons((_BAD_DATE, 'wrong_date'))} as error_reason from cl",
    "date_year_typed": f"select * from ({SHIFTED.replace('{orders}', 'orders')}) where year(o_day) not between 1963 "
                       "and 2100 and year(o_day) <> 9999",
    "validate_joined": f"{STANDARDISED_SQL} select * from (select *, {_FOUR} as error_reason from std) "
                       "where error_reason <> ''",
    "excluded_table": f"{STANDARDISED_SQL} select * from (select *, {_FOUR} as error_reason from std) "
                      "where error_reason <> ''",
    "clean_split": f"{STANDARDISED_SQL} select {_ALL} from (select *, {_FOUR} as error_reason from std) "
                   "where error_reason = ''",
    "rule_hits": f"{cleaned_sql()}{_UNION} select reason, count(*) as distinct_rows from (select distinct reason, "
                 f"{_ALL} from hits) group by 1",
    "excluded_array": f"{cleaned_sql()}{_UNION} select * from report",
    "clean_subtract": f"{cleaned_sql()}{_UNION} select * from cl except select {_ALL} from report",
    "hierarchy_conflicts": f"{cleaned_sql()} select child_level, parent_level, child_value, parent as parent_value, "
                           "count(*) over (partition by child_level, parent_level, child_value) as parents from ("
                           f"select distinct * from ({_level_lines(_PAIRS, 'cl')}) where parent is not null) "
                           "qualify parents > 1",
    "hierarchy_warnings": f"{cleaned_sql()} {_warnings(_PAIRS, 'cl')}",
    "inconsistent_children": f"{cleaned_sql()} select child_value as local_hierarchy_level3_desc, parents as "
                             "Corresponding_local_hierarchy_level2_desc from ("
                             + _warnings([("local_hierarchy_level2_desc", "local_hierarchy_level3_desc")], "cl") + ")",
    "hierarchy_geography": "with rows_ as (select * from customer join nation on c_nationkey = n_nationkey join region "
                           "on n_regionkey = r_regionkey) "
                           + _warnings([("r_name", "n_name"), ("n_name", "c_mktsegment")], "rows_"),
    # Each segment has a good part of all customers above it.
    "hierarchy_summary": "select 'c_mktsegment' as child_level, 'c_name' as parent_level, child_value, n_parents, "
                         "string_agg(parent, '|' order by parent) as first_parents from (select *, row_number() over "
                         "(partition by child_value order by parent) as place, count(*) over (partition by child_value) "
                         "as n_parents from (select distinct c_mktsegment as child_value, c_name as parent from "
                         "customer where c_name is not null)) where place <= 5 and n_parents > 1 group by all",
}

"""Brand queries: completion, spelling, roots, similarity, unification."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.constants import BRAND_COLUMNS
from shelfwise.functions import similarity, text
from shelfwise.operators import brands as B
from shelfwise.operators.similar import similar_brand_mapping
from shelfwise.plans.cleaning import clean_and_unify
from shelfwise.sources.tables import concat_sources
from workload.base import (
    DATASET, PRODUCT_COLUMNS, STANDARD_COLUMNS, branded, branded_sql, cleaned, products, products_sql, root_sql, table,
)

THRESHOLD = 0.85

# Reference brands by barcode come in two lists; some entries name no brand, some codes occur in both lists.
REFERENCES = [
    """select case when p_partkey % 97 = 0 then null else lpad(cast(p_partkey as string), 13, '0') end as code,
         case when p_partkey % 2 = 0 then null when p_partkey % 9 = 0 then '' else upper(p_brand) end as brand,
         p_partkey as row_order from {part} where p_partkey % 3 <> 1""",
    """select lpad(cast(p_partkey as string), 13, '0') as code, concat('REF ', upper(p_brand)) as brand,
         p_partkey as row_order from {part} where p_partkey % 5 <> 1""",
]
ORDER = ["source_rank", "row_order"]

# The mapping a user saved earlier: two lines for some brands, and targets that are keys themselves.
SAVED_MAPPING = """select concat('BRAND#', cast(r_regionkey as string)) as brand,
    concat('BRAND#', cast(r_regionkey + 1 as string)) as standard_brand from {region}
  union all select 'BRAND#1', 'BRAND ONE' from {region}"""

LINES = "select concat(upper(p_name), ' ', upper(p_brand)) as brand, count(*) as freq from {part} group by 1"

# Long lines with one common stem: most are similar to many others.
SUPPLIER_LINES = """select concat(upper(s_name), ' DELIVERS TO ', n_name, ' OF ', r_name, ' FOR ', cast(s_acctbal as string))
    as brand, cast(1 + s_suppkey % 4 as bigint) as freq
  from {supplier} join {nation} on s_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey"""


def _supplier_lines(spark, sf):
    tables = {name: table(spark, sf, name) for name in ("supplier", "nation", "region")}
    return spark.sql(SUPPLIER_LINES, **tables)


def _references(spark, sf):
    part = table(spark, sf, "part")
    return concat_sources([spark.sql(q, part=part) for q in REFERENCES], rank="source_rank")


def _completed(named_only):
    return lambda s, d: B.complete_brand(branded(s, d), _references(s, d), ORDER, named_only=named_only)


def _root_pairs(spark, sf):
    rooted = B.root_brands(branded(spark, sf))
    return rooted.select(F.col("local_brand_name").alias("a"), F.col("global_brand_name").alias("b")).filter(
        "a is not null and b is not null").groupBy("a", "b").agg(F.count(F.lit(1)).alias("pair_rows"))


def _similarity(spark, sf):
    a, b = F.col("a"), F.col("b")
    freq = F.col("pair_rows")
    return _root_pairs(spark, sf).select(
        "a", "b", F.array_join(F.array_sort(text.ngrams(a)), "|").alias("grams_a"),
        similarity.shared_ngrams(a, b).alias("shared"),
        F.round(similarity.indel_ratio(a, b), 9).alias("ratio"),
        similarity.canonical_of(a, freq, b, F.lit(20)).alias("canonical"),
    )


def _unify_reuse(spark, sf):
    saved = spark.sql(SAVED_MAPPING, region=table(spark, sf, "region"))
    return B.unify_brands(branded(spark, sf), mapping=saved)[0]


def _counts(spark, sf):
    return B.brand_counts(B.root_brands(branded(spark, sf)))


QUERIES = {
    "freq_standardise": lambda s, d: B.standardise_by_frequency(branded(s, d), STANDARD_COLUMNS, PRODUCT_COLUMNS),
    "spelling_mapping": lambda s, d: B.spelling_mapping(branded(s, d), STANDARD_COLUMNS),
    "root_standardise": lambda s, d: B.root_standardise(products(s, d), "local_supplier_desc"),
    "root_mapping": lambda s, d: B.root_mapping(products(s, d), "local_supplier_desc"),
    "brand_mode": lambda s, d: B.mode_per_group(
        cleaned(s, d), ["global_hierarchy_level2_desc"], "global_brand_name"),
    "concat_references": _references,
    "complete_brand_first_row": _completed(False),
    "complete_brand_first_nonempty": _completed(True),
    "brand_root": lambda s, d: products(s, d, with_id=True).select(
        "row_id", text.brand_root(F.col("local_brand_name")).alias("local_root"),
        text.brand_root(F.col("global_brand_name")).alias("global_root")),
    "brand_counts": _counts,
    "distinct_brands": lambda s, d: B.stacked_values(branded(s, d), BRAND_COLUMNS).distinct(),
    "indel_similarity": _similarity,
    "brand_mapping": lambda s, d: B.build_brand_mapping(branded(s, d), threshold=THRESHOLD),
    "line_mapping": lambda s, d: similar_brand_mapping(spark_lines(s, d), THRESHOLD),
    "customer_name_mapping": lambda s, d: similar_brand_mapping(
        table(s, d, "customer").select(F.upper("c_name").alias("brand"), F.lit(1).alias("freq")), THRESHOLD),
    "supplier_line_mapping": lambda s, d: similar_brand_mapping(_supplier_lines(s, d), THRESHOLD),
    "unify_brands_build": lambda s, d: B.unify_brands(branded(s, d), threshold=THRESHOLD)[0],
    "unify_brands_reuse": _unify_reuse,
    "clean_and_unify": lambda s, d: clean_and_unify(
        products(s, d), DATASET, _references(s, d), ORDER,
        s.sql(SAVED_MAPPING, region=table(s, d, "region")))[0],
}


def spark_lines(spark, sf):
    return spark.sql(LINES, part=table(spark, sf, "part"))


# ---- oracles ----------------------------------------------------------------------------------------------------

def _form(c):
    return f"nullif(regexp_replace(upper({c}), '[^A-Z0-9]', '', 'g'), '')"


_SPELLINGS = ", sp as (" + " union all ".join(
    f"select '{c}' as column_name, {c} as value from nb" for c in STANDARD_COLUMNS) + f"""),
counted as (select column_name, value, {_form('value')} as normal_form, count(*) as n from sp group by all),
mapping as (select column_name, normal_form, first(value order by n desc, value) as standard from counted
  where normal_form is not null group by 1, 2 having count(*) > 1)"""

_STANDARD = ", ".join(
    f"coalesce((select standard from mapping m where m.column_name = '{c}' and m.normal_form = {_form('nb.' + c)}), "
    f"nb.{c}) as {c}" for c in STANDARD_COLUMNS)

STANDARDISED_SQL = f"{branded_sql()}{_SPELLINGS}, std as (select nb.* replace ({_STANDARD}) from nb)"

_ROOT = "upper(regexp_replace(local_supplier_desc, '[^A-Z0-9]', '', 'g'))"
_ROOT_MAPPING = f"""with products as ({products_sql()}), rooted as (select {_ROOT} as root, local_supplier_desc as v,
  count(*) as n from products where local_supplier_desc is not null group by all),
  mapping as (select root, first(v order by n desc, v) as standard from rooted group by 1)"""

_REFS = " union all ".join(
    f"select *, {i} as source_rank from ({q.replace('{part}', 'part')})" for i, q in enumerate(REFERENCES))


def _completed_sql(named_only):
    keep = "where brand <> ''" if named_only else ""
    fill = (lambda c: f"case when coalesce(nb.{c}, '') = '' then coalesce(f.brand, nb.{c}) else nb.{c} end as {c}"
            ) if named_only else (lambda c: f"coalesce(nb.{c}, f.brand) as {c}")
    return (f"{branded_sql()}, refs as ({_REFS}), f as (select code, brand from (select code, brand, row_number() "
            f"over (partition by code order by source_rank, row_order) as rn from refs {keep}) where rn = 1), "
            f"done as (select nb.* replace ({', '.join(fill(c) for c in BRAND_COLUMNS)}) from nb left join f "
            "on nb.barcode is not distinct from f.code)")


def _grams(c):
    return (f"list_distinct(list_transform(range(1, greatest(length(upper({c})) - 1, 2)), "
            f"lambda i: substr(upper({c}), i::int, 3)))")


def _lcs(pairs):
    """Common table expressions adding ``scored`` (a, b, lcs) for the distinct pairs (a, b) of ``pairs``."""
    return f""", dp(a, b, i, prev) as (
  select a, b, 0, list_transform(range(0, length(b) + 1), lambda j: 0::bigint) from {pairs}
  union all
  select a, b, i + 1, list_reduce(list_transform(range(1, length(b) + 1), lambda j: [j]),
    lambda acc, x: list_append(acc, case when substr(a, i + 1, 1) = substr(b, x[1]::int, 1) then prev[x[1]] + 1
      else greatest(prev[x[1] + 1], acc[x[1]]) end), [0::bigint]) from dp where i < length(a)),
scored as (select a, b, prev[length(b) + 1] as lcs from dp where i = length(a))"""


def _mapping_sql(freq):
    """From a relation ``freq`` (brand, freq): all pairs of a block, compared exactly; best partner per brand."""
    return f""", pairs as (
  select x.brand as a, y.brand as b from {freq} x join {freq} y on substr(x.brand, 1, 1) = substr(y.brand, 1, 1)
    and abs(length(x.brand) - length(y.brand)) <= 1 and x.brand < y.brand
  where levenshtein(x.brand, y.brand) <= {1 - THRESHOLD} * (length(x.brand) + length(y.brand)) + 0.000001
    and len(list_intersect({_grams('x.brand')}, {_grams('y.brand')})) >= 2){_lcs('pairs')},
matched as (select a, b from scored
  where 1 - (length(a) + length(b) - 2 * lcs) / (length(a) + length(b))::double >= {THRESHOLD}),
both_ways as (select a as brand, b as other from matched union all select b, a from matched),
ranked as (select m.brand, f.brand as standard_brand, f.freq from both_ways m join {freq} f on f.brand = m.other
  union all select distinct m.brand, f.brand, f.freq from both_ways m join {freq} f on f.brand = m.brand),
best as (select brand, first(standard_brand order by freq desc, length(standard_brand) desc, standard_brand)
  as standard_brand from ranked group by brand),
brand_map as (select * from best where brand <> standard_brand)"""


def _recursive(sql):
    return sql.replace("with ", "with recursive ", 1)


_ROOTED = (f"{branded_sql()}, rooted as (select nb.* replace ("
           + ", ".join(f"{root_sql('nb.' + c)} as {c}" for c in BRAND_COLUMNS) + ") from nb)")
_COUNTED = (f"{_ROOTED}, freq as (select brand, count(*) as freq from (select local_brand_name as brand from rooted "
            "union all select global_brand_name from rooted) where brand is not null group by 1)")


def _replaced(mapping):
    return ", ".join(f"coalesce((select m.standard_brand from {mapping} m where m.brand = r.{c}), r.{c}) as {c}"
                     for c in BRAND_COLUMNS)


_SAVED = (", saved as (select brand, max(standard_brand) as standard_brand from ("
          f"{SAVED_MAPPING.replace('{region}', 'region')}) group by 1)")

# All customer names have 18 characters, so two are similar when both can lose two characters and agree.
_CUSTOMERS = ("with n as (select upper(c_name) as brand from customer), r as (select distinct brand, substr(brand, 1, "
              "i - 1) || substr(brand, i + 1, j - i - 1) || substr(brand, j + 1) as rest from n, (select unnest(range("
              "1, 18)) as i), (select unnest(range(2, 19)) as j) where j > i), b as (select rest, min(brand) as best "
              "from r group by 1) select brand, min(best) as standard_brand from r join b using (rest) group by 1 "
              "having min(best) < brand")

ORACLES = {
    "customer_name_mapping": _CUSTOMERS,
    "freq_standardise": f"{STANDARDISED_SQL} select * from std",
    "spelling_mapping": f"{branded_sql()}{_SPELLINGS} select * from mapping",
    "root_standardise": f"{_ROOT_MAPPING} select p.* replace (coalesce(m.standard, p.local_supplier_desc) as "
                        f"local_supplier_desc) from products p left join mapping m on m.root = {_ROOT}",
    "root_mapping": f"{_ROOT_MAPPING} select * from mapping",
    "brand_mode": f"{branded_sql()}, n as (select global_hierarchy_level2_desc, global_brand_name as v, count(*) as n "
                  "from cl where global_brand_name is not null group by all) select global_hierarchy_level2_desc, "
                  "first(v order by n desc, v) as mode from n group by 1",
    "concat_references": f"select * from ({_REFS})",
    "complete_brand_first_row": f"{_completed_sql(False)} select * from done",
    "complete_brand_first_nonempty": f"{_completed_sql(True)} select * from done",
    "brand_root": f"with products as ({products_sql(True)}) select row_id, {root_sql('local_brand_name')} as "
                  f"local_root, {root_sql('global_brand_name')} as global_root from products",
    "brand_counts": f"{_COUNTED} select * from freq",
    "distinct_brands": f"{branded_sql()} select 'local_brand_name' as column_name, local_brand_name as value from nb "
                       "union select 'global_brand_name', global_brand_name from nb",
    "indel_similarity": _recursive(
        f"{_ROOTED}, p as (select local_brand_name as a, global_brand_name as b, count(*) as pair_rows from rooted "
        f"where local_brand_name is not null and global_brand_name is not null group by all){_lcs('p')} "
        f"select a, b, array_to_string(list_sort({_grams('a')}), '|') as grams_a, "
        f"len(list_intersect({_grams('a')}, {_grams('b')}))::int as shared, "
        "round(1 - (length(a) + length(b) - 2 * lcs) / (length(a) + length(b))::double, 9) as ratio, "
        "case when pair_rows > 20 then a when pair_rows < 20 then b when length(b) > length(a) then b else a end "
        "as canonical from p join scored using (a, b)"),
    "brand_mapping": _recursive(f"{_COUNTED}{_mapping_sql('freq')} select * from brand_map"),
    "line_mapping": _recursive(f"with freq as ({LINES.replace('{part}', 'part')}){_mapping_sql('freq')} "
                               "select * from brand_map"),
    "supplier_line_mapping": _recursive(
        f"with freq as ({SUPPLIER_LINES.format(supplier='supplier', nation='nation', region='region')})"
        f"{_mapping_sql('freq')} select * from brand_map"),
    "unify_brands_build": _recursive(f"{_COUNTED}{_mapping_sql('freq')} select r.* replace ({_replaced('brand_map')}) "
                                     "from rooted r"),
    "unify_brands_reuse": f"{_ROOTED}{_SAVED} select r.* replace ({_replaced('saved')}) from rooted r",
    "clean_and_unify": f"{_completed_sql(False)}, r as (select done.* replace ("
                       + ", ".join(f"{root_sql('done.' + c)} as {c}" for c in BRAND_COLUMNS)
                       + f") from done){_SAVED} select r.* replace ({_replaced('saved')}) from r",
}

"""Inputs shared by the queries, and SQL fragments shared by their oracles."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from shelfwise import constants as C
from shelfwise.config import Dataset
from shelfwise.operators.clean import clean_frame, null_brands
from shelfwise.operators.materialise import settle, spread

Query = Callable[[SparkSession, str], DataFrame]

DATASET = Dataset(raw="products", clean="products_clean", excluded="products_excluded")
SUPPLIER_COLUMNS = ("local_supplier_desc", "global_supplier_desc")
STANDARD_COLUMNS = (*C.BRAND_COLUMNS, *SUPPLIER_COLUMNS)

# The given tables hold no products, so a product table is derived from ``part``; both engines run this text.
# Every 50th and 75th part occurs again, some cells are damaged, and spellings vary.
PRODUCTS = """
select {row_id} cast(k % 5 as string) as country_id,
  case when k % 97 = 0 then null
       when k % 13 = 0 then substr('1234567890123', 1, cast(k % 14 as int))
       else lpad(cast(k as string), 13, '0') end as barcode,
  concat('  ', p_name, case when k % 4 = 0 then ' crème  brûlée' else '' end,
         case when cp = 2 then ' bis' else '' end) as item_desc,
  case when k % 41 = 0 then concat('TEX', chr(160), 'IMPORT \u3000 12') when k % 47 = 0 then 'TEX ① ²'
       when k % 11 = 0 then 'SANS MARQUE' when k % 43 = 0 then 'n/a' when k % 3 = 0 then replace(p_brand, '#', ' ')
       when k % 3 = 1 then concat(p_brand, ' IMPORT') else p_brand end as local_brand_name,
  case when k % 7 = 0 then null when k % 5 = 0 then concat(replace(p_brand, '#', '-'), ' ', cast(k % 9 as string))
       else p_brand end as global_brand_name,
  case when k % 59 = 0 then '---' when k % 6 = 0 then concat('Maison ', p_name)
       when k % 6 = 1 then concat('MAISON-', p_name) else concat('maison_', p_name) end as local_supplier_desc,
  case when k % 53 = 0 then '' when k % 4 = 1 then concat('Ste. ', p_brand) else concat('STE ', p_brand)
       end as global_supplier_desc,
  split_part(p_name, ' ', 1) as color_desc,
  case when p_size % 4 = 0 then null else cast(p_size as string) end as size_desc,
  case when k % 101 = 0 then 'FOOD' when p_type in ('ECONOMY', 'PROMO') then 'FOOD' else 'NO FOOD'
       end as hierarchy_level1_desc,
  p_type as global_hierarchy_level2_desc,
  concat(p_type, '/', split_part(p_name, ' ', 2)) as global_hierarchy_level3_desc,
  concat(p_type, '/', p_name) as global_hierarchy_level4_desc,
  case when k % 103 = 0 then p_name else concat(p_type, '/', p_name, '/', p_brand) end as global_hierarchy_level5_desc,
  case when k % 107 = 0 then null else concat(p_type, '/', p_name, '/', p_brand, '/', cast(p_size as string))
       end as global_hierarchy_level6_desc,
  concat('local ', p_type) as local_hierarchy_level2_desc,
  split_part(p_name, ' ', 2) as local_hierarchy_level3_desc,
  concat(split_part(p_name, ' ', 2), '/', p_brand) as local_hierarchy_level4_desc,
  p_brand as local_hierarchy_level5_desc,
  concat(p_brand, '/', cast(p_size as string)) as local_hierarchy_level6_desc,
  case when k % 17 = 0 then '2024-02-30' when k % 19 = 0 then '1950-01-01' when k % 23 = 0 then '9999-12-31'
       when k % 29 = 0 then '2024/01/01' when k % 31 = 0 then '2024-1-5' when k % 37 = 0 then null
       else '2024-06-15' end as non_active_date,
  cast(case when k % 101 = 0 then 1 else 0 end as int) as is_error
from (
  select p_partkey as k, p_name, p_brand, p_type, p_size, 0 as cp from {part}
  union all select p_partkey, p_name, p_brand, p_type, p_size, 1 from {part} where p_partkey % 50 = 0
  union all select p_partkey, p_name, p_brand, p_type, p_size, 2 from {part} where p_partkey % 75 = 0) rep
"""
ROW_ID = "k * 3 + cp as row_id,"

PRODUCT_TEXTS = (
    "country_id", "barcode", "item_desc", *C.BRAND_COLUMNS, *SUPPLIER_COLUMNS, "color_desc", "size_desc",
    *C.GLOBAL_LEVELS, *C.LOCAL_LEVELS[1:], "non_active_date",
)
PRODUCT_COLUMNS = (*PRODUCT_TEXTS, "is_error")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def products(spark: SparkSession, sf_dir: str, with_id: bool = False) -> DataFrame:
    # The copies come first and are dealt together: a branch of the union that is dealt by itself leaves a small file
    # beside each large one, and a scan reads its files by size, most of the rows in few tasks.
    items, copies = PRODUCTS.removesuffix(") rep\n").split("from (\n")
    rep = spread(spark.sql(copies, part=table(spark, sf_dir, "part")))
    return spark.sql(items.replace("{row_id}", ROW_ID if with_id else "") + "from {rep}", rep=rep)


def cleaned(spark: SparkSession, sf_dir: str, with_id: bool = False) -> DataFrame:
    return clean_frame(products(spark, sf_dir, with_id))


def clean_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned products as a written table, as the validation step finds them."""
    return settle(cleaned(spark, sf_dir), "clean-products").frame


def branded(spark: SparkSession, sf_dir: str, with_id: bool = False) -> DataFrame:
    return null_brands(cleaned(spark, sf_dir, with_id))


# ---- SQL fragments ----------------------------------------------------------------------------------------------

def quoted(words: Sequence[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


EDGES = quoted([C.EDGE_SPACES])
MISSING = quoted(C.MISSING_BRANDS)


def clean_sql(c: str) -> str:
    marks = rf"regexp_replace(strip_accents({c}), '\p{{M}}', '', 'g')"
    spaces = rf"regexp_replace({marks}, '[ \t\n\f\r]+', ' ', 'g')"
    return (f"case when upper(trim({c}, {EDGES})) in ({quoted(C.NULL_WORDS)}) then null "
            f"else trim(upper(replace({spaces}, 'ß', 'SS')), {EDGES}) end")


def root_sql(c: str) -> str:
    # Every white space becomes a blank first; digits are those of the decimal category and the listed others.
    plain = f"regexp_replace(upper({c}), '[\\x09-\\x0D\\x1C-\\x1F\\x85\\p{{Z}}]', ' ', 'g')"
    words = (f"list_filter(string_split(trim({plain}), ' '), lambda w: w <> '' and w not in ({quoted(C.NOISE_TOKENS)}) "
             f"and not regexp_full_match(w, '[\\p{{Nd}}²³¹①-⑨]+'))")
    return (f"case when {c} is null then null when contains(upper({c}), 'PETIT BATEAU') then 'PETIT BATEAU' "
            f"else coalesce(nullif(array_to_string({words}, ' '), ''), upper({c})) end")


def products_sql(with_id: bool = False) -> str:
    return PRODUCTS.replace("{row_id}", ROW_ID if with_id else "").replace("{part}", "part")


def cleaned_sql(with_id: bool = False) -> str:
    """Common table expressions up to ``cl``, the cleaned products."""
    texts = ", ".join(f"{clean_sql(c)} as {c}" for c in PRODUCT_TEXTS)
    extra = "row_id, " if with_id else ""
    return f"with products as ({products_sql(with_id)}), cl as (select {extra}{texts}, is_error from products)"


def branded_sql(with_id: bool = False) -> str:
    """Common table expressions up to ``nb``: cleaned, "no brand" words nulled."""
    brands = ", ".join(f"case when {c} in ({MISSING}) then null else {c} end as {c}" for c in C.BRAND_COLUMNS)
    return f"{cleaned_sql(with_id)}, nb as (select * replace ({brands}) from cl)"


def columns_sql(columns: Sequence[str] = PRODUCT_COLUMNS, prefix: str = "") -> str:
    return ", ".join(prefix + c for c in columns)

from __future__ import annotations

import itertools
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from shelfwise import constants as C
from shelfwise.functions import text
from shelfwise.functions.similarity import canonical_of, common_length, indel_ratio, shared_ngrams


def apply(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    return [r[0] for r in df.select(fn("t")).collect()]


def on_column(fn):
    return lambda name: fn(F.col(name))


def test_clean_text(spark):
    cells = {
        "  Crème   brûlée ": "CREME BRULEE", " n/a ": None, "": None, "N.A!": None, "null": None, "Nan": None,
        "\tNA\n": None, None: None, "a\t\nb": "A B", "straße": "STRASSE", "\xa0x\xa0y\xa0": "X\xa0Y",
        "a ́ b": "A B", "it's `x` \\ y": "IT'S `X` \\ Y", "ǘ Ấ ñ": "U A N", "N/Á": "N/A",
    }
    assert apply(spark, cells, text.clean_text) == list(cells.values())


def test_clean_text_of_all_short_cells(spark):
    cells = ["".join(c) for n in range(5) for c in itertools.product(" \t\f\x0b\x1cNaé", repeat=n)]
    cells += [f"{a}long cell{b}" for a in C.EDGE_SPACES for b in C.EDGE_SPACES] + ["NULLS", "null", "fine cell", "a\rb"]

    def cleaned(cell):
        plain = re.sub("[ \t\n\f\r]+", " ", cell.replace("é", "e")).upper().strip(C.EDGE_SPACES)
        return None if cell.strip(C.EDGE_SPACES).upper() in C.NULL_WORDS else plain

    assert apply(spark, cells, text.clean_text) == [cleaned(cell) for cell in cells]


def test_tidy_cells_are_known(spark):
    cells = ["TEX 12", "fine cell", "a", "", " a", "a ", "a  b", "a\tb", "a\rb", "a\fb", "\x1ca", "é", "a\xa0"]
    tidy = apply(spark, cells, lambda c: F.expr(text._is_tidy(c)))
    assert tidy == [True] * 3 + [False] * 10


def test_clean_text_is_idempotent(spark):
    once = apply(spark, ["  Crème   brûlée ", "ß", "한국"], text.clean_text)
    assert apply(spark, once, text.clean_text) == once


def test_accents_equal_canonical_decomposition(spark):
    singles = [chr(c) for c in range(0xA0, 0x2000)] + ["한", "가", "힣", "값", "ﬁ", "豈", "が"]
    expected = ["".join(p for p in unicodedata.normalize("NFD", ch) if not unicodedata.category(p).startswith("M"))
                for ch in singles]
    got = apply(spark, singles, text.strip_accents)
    # Marks newer than the Java tables may stay; everything that decomposes must agree.
    differing = [ch for ch, g, e in zip(singles, got, expected) if g != e and unicodedata.normalize("NFD", ch) != ch]
    assert differing == []


@pytest.mark.parametrize("cell,root", [
    ("PETIT BATEAU 62 NUIT RIST", "PETIT BATEAU"), ("IMPORT 12", "IMPORT 12"), ("LA 12 COURONNE IMPORT", "LA COURONNE"),
    ("tex net", "TEX"), ("X LIGNE DE", "X LIGNE DE"), (None, None), ("VIEUXPETIT BATEAUX", "PETIT BATEAU"),
    ("A  B", "A B"), ("٣ A", "A"),
])
def test_brand_root(spark, cell, root):
    assert apply(spark, [cell], on_column(text.brand_root)) == [root]


def test_normal_forms(spark):
    assert apply(spark, ["L'Oréal 3", "--", None], on_column(text.alphanumeric_form)) == ["LORAL3", None, None]
    late = apply(spark, ["L'Oreal 3", "--", None], lambda c: text.alphanumeric_form(F.col(c), upper_first=False))
    assert late == ["LO3", "", None]


def test_missing_brands(spark):
    assert apply(spark, [*C.MISSING_BRANDS, "sans", "TEX", None], on_column(text.null_if_missing_brand)) == (
        [None] * len(C.MISSING_BRANDS) + ["sans", "TEX", None])


def test_barcodes(spark):
    cells = ["1234567", "12345678", "1234567890", "1234567890123", "123456789", "", None]
    assert apply(spark, cells, on_column(text.wrong_barcode)) == [False] * 4 + [True, False, False]
    strict = apply(spark, cells, lambda c: text.wrong_barcode(F.col(c), empty_fails=True))
    assert strict == [False] * 4 + [True, True, False]


def test_days(spark):
    good = ["9999-12-31", "1963-01-01", "2100-12-31", "2024-1-5", "2024-01- 5", "2024-02-29", "", None]
    bad = ["1962-12-31", "2101-01-01", "2024-02-30", "24-1-5", "20240105", "2024-001-5", "-2024-1-5", "0000-01-01",
           "2024-01-05 00:00:00", "2024-13-01", "2024-00-01", "x"]
    assert apply(spark, good + bad, on_column(text.wrong_day)) == [False] * len(good) + [True] * len(bad)


def test_repair(spark):
    cells = {"Misi?n": "Misión", "Mision?": "Mision?", "Misión": "Misión", None: None}
    assert apply(spark, cells, on_column(text.repair_cell)) == list(cells.values())


def test_ngrams(spark):
    assert apply(spark, ["abcab", "ab", "aaaa", None], on_column(text.ngrams)) == [
        ["ABC", "BCA", "CAB"], ["AB"], ["AAA"], None]


def test_descriptions(spark):
    df = spark.createDataFrame([("I", "L", "G"), ("I", None, "G"), (None, None, None)], "i string, l string, g string")
    described = df.select(text.describe(*map(F.col, "ilg")), text.level_path([F.col(c) for c in "ilg"])).collect()
    assert [tuple(r) for r in described] == [
        ("Description du produit: Ilocal_brand_name: L, global_brand_name: G", "I > L > G"),
        ("", "I >  > G"), ("", " >  > ")]


def test_similarity(spark):
    pairs = [("LA COURONN", "LA COURONNE", 10), ("kitten", "sitting", 4), ("", "A", 0), ("ABCD", "ABXCD", 4), ("", "", 0)]
    df = spark.createDataFrame(pairs, "a string, b string, n int")
    rows = df.select("a", "b", "n", common_length(F.col("a"), F.col("b")).alias("lcs"),
                     indel_ratio(F.col("a"), F.col("b")).alias("ratio"),
                     shared_ngrams(F.col("a"), F.col("b")).alias("shared")).collect()
    for r in rows:
        total = len(r.a) + len(r.b)
        assert r.lcs == r.n
        assert r.ratio == pytest.approx(1 - (total - 2 * r.n) / total if total else 1.0)
    assert rows[0].shared == 8


def test_canonical(spark):
    df = spark.createDataFrame([("AB", 2, "XYZ", 1), ("AB", 1, "XYZ", 1), ("AB", 1, "XY", 1), ("AB", None, "X", 1)],
                               "a string, fa int, b string, fb int")
    chosen = df.select(canonical_of(F.col("a"), F.col("fa"), F.col("b"), F.col("fb"))).collect()
    assert [r[0] for r in chosen] == ["AB", "XYZ", "AB", "X"]


def test_root_knows_all_white_space_and_digits(spark):
    rows = [("TEX IMPORT", "TEX"), ("TEX 　 12", "TEX"), ("TEX ①", "TEX"), ("TEX\x1c12", "TEX"),
            ("TEX ②³ ٣", "TEX"), ("TEX ½", "TEX ½")]
    df = spark.createDataFrame([(a,) for a, _ in rows], "b string")
    assert [r[0] for r in df.select(text.brand_root(F.col("b"))).collect()] == [b for _, b in rows]


def test_day_with_a_line_end_is_no_day(spark):
    df = spark.createDataFrame([("2024-01-05\n",), ("2024-01-05",)], "d string")
    assert [r[0] is None for r in df.select(text.parse_day(F.col("d"))).collect()] == [True, False]

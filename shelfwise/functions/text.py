"""Column expressions on text: cleaning, normal forms, brand roots, cell checks. All run inside the JVM."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Mapping, Sequence
from functools import lru_cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise import constants as C

HANGUL_BLOCK = "[가-힣]"
HANGUL_FIRST = 0xAC00
# The three letter series from which composed Hangul syllables are built (Unicode, chapter 3.12).
JAMO_LEAD = "".join(map(chr, range(0x1100, 0x1113)))
JAMO_VOWEL = "".join(map(chr, range(0x1161, 0x1176)))
JAMO_TAIL = "".join(map(chr, range(0x11A8, 0x11C3)))

# What parts words: Unicode white space and the four separator characters before the blank.
WORD_GAP = "[" + C.EDGE_SPACES + "\x1c-\x1f]+"


@lru_cache(maxsize=1)
def all_digits() -> str:
    """A pattern for texts of digits only: every character with a digit value, circled and raised ones included."""
    codes = [code for code in range(sys.maxunicode + 1) if unicodedata.digit(chr(code), None) is not None]
    parts, first = [], codes[0]
    for code, following in zip(codes, [*codes[1:], None]):
        if following != code + 1:
            parts.append(f"\\x{{{first:X}}}-\\x{{{code:X}}}")
            first = following
    return "^[" + "".join(parts) + "]+$"


@lru_cache(maxsize=1)
def _base_letters() -> tuple[str, str]:
    """All characters that decompose to one base character plus marks, and those base characters."""
    composed, base = [], []
    for code in range(0x80, sys.maxunicode + 1):
        ch = chr(code)
        parts = unicodedata.normalize("NFD", ch)
        if parts == ch:
            continue
        kept = [p for p in parts if not unicodedata.category(p).startswith("M")]
        if len(kept) == 1:
            composed.append(ch)
            base.append(kept[0])
    return "".join(composed), "".join(base)


def _literal(text: str) -> str:
    """A SQL string literal whose backslashes stay as they are."""
    return "r'" + text + "'" if "\\" in text else "'" + text.replace("'", "''") + "'"


def _name(column: str) -> str:
    return f"`{column}`"


def _split_hangul(c: str) -> str:
    """SQL: composed Hangul syllables of ``c`` taken apart into their letters."""
    at = f"(ascii(ch) - {HANGUL_FIRST})"
    lead = f"substring('{JAMO_LEAD}', {at} div 588 + 1, 1)"
    vowel = f"substring('{JAMO_VOWEL}', {at} % 588 div 28 + 1, 1)"
    tail = f"if({at} % 28 = 0, '', substring('{JAMO_TAIL}', {at} % 28, 1))"
    letters = f"ch -> if(ch rlike '{HANGUL_BLOCK}', concat({lead}, {vowel}, {tail}), ch)"
    return f"if({c} rlike '{HANGUL_BLOCK}', array_join(transform(split({c}, ''), {letters}), ''), {c})"


def _is_ascii(c: str) -> str:
    return f"octet_length({c}) = char_length({c})"


def _fold(c: str) -> str:
    composed, base = _base_letters()
    return rf"regexp_replace(translate({_split_hangul(c)}, {_literal(composed)}, {_literal(base)}), r'\p{{M}}', '')"


def strip_accents(column: str) -> Column:
    """Canonical decomposition with all combining marks removed. Plain ASCII cells skip the work."""
    c = _name(column)
    return F.expr(f"if({_is_ascii(c)}, {c}, {_fold(c)})")


def _squeeze(text: str) -> str:
    """SQL: every run of blank, tab and line-end characters becomes one blank; a single blank is not touched."""
    return rf"regexp_replace({text}, r' [ \t\n\f\r]+|[\t\n\f\r][ \t\n\f\r]*', ' ')"


def _is_tidy(c: str) -> str:
    """SQL: plain ASCII text that neither trimming nor squeezing would change. Every white space in ASCII sorts before
    ``!``, so the ends are only compared."""
    runs = " or ".join(f"contains({c}, {_literal(gap)})" for gap in ("  ", "\t", "\n", "\f", "\r"))
    return f"{_is_ascii(c)} and {c} >= '!' and right({c}, 1) >= '!' and not ({runs})"


def trim_edges(text: Column) -> Column:
    return F.btrim(text, F.lit(C.EDGE_SPACES))


def clean_text(column: str) -> Column:
    """Accents off, white space squeezed to single blanks, upper case, trimmed.

    Null where the raw cell is one of the words for "no value". Tidy cells, most of a usual table, are only put in
    upper case. Written as one SQL text: wide tables have many text columns, and building this call by call would take
    longer than a small job.
    """
    c, edges = _name(column), _literal(C.EDGE_SPACES)
    squeezed = f"if({_is_ascii(c)}, {_squeeze(c)}, {_squeeze(_fold(c))})"
    words = ", ".join(map(_literal, C.NULL_WORDS))
    longest = max(len(word.encode()) for word in C.NULL_WORDS)
    return F.expr(
        f"case when {_is_tidy(c)} then if(octet_length({c}) > {longest} or upper({c}) not in ({words}), upper({c}), null) "
        f"when upper(btrim({c}, {edges})) not in ({words}) then btrim(upper({squeezed}), {edges}) end")


def null_if_missing_brand(brand: Column) -> Column:
    return F.when(~brand.isin(*C.MISSING_BRANDS), brand)


def alphanumeric_form(text: Column, upper_first: bool = True) -> Column:
    """Letters A-Z and digits only. Upper-casing last loses lower-case letters: the archived variant."""
    if upper_first:
        return F.nullif(F.regexp_replace(F.upper(text), "[^A-Z0-9]", ""), F.lit(""))
    return F.upper(F.regexp_replace(text, "[^A-Z0-9]", ""))


def brand_root(brand: Column) -> Column:
    """A verified brand found inside wins; else the brand without noise words and numbers. A single word stays."""
    upper = F.upper(brand)
    kept = F.filter(
        F.split(trim_edges(upper), WORD_GAP),
        lambda word: (word != "") & ~word.isin(*C.NOISE_TOKENS) & ~word.rlike(all_digits()),
    )
    several = F.coalesce(F.nullif(F.array_join(kept, " "), F.lit("")), upper)
    root = F.when(~upper.rlike(WORD_GAP), upper).otherwise(several)
    return reduce(
        lambda rest, name: F.when(upper.contains(name), name).otherwise(rest), reversed(C.VERIFIED_BRANDS), root
    )


def ngrams(text: Column, n: int = 3) -> Column:
    """The set of character n-grams of the upper-cased text; a shorter text is its own only gram."""
    upper = F.upper(text)
    starts = F.sequence(F.lit(1), F.greatest(F.char_length(upper) - (n - 1), F.lit(1)))
    return F.when(upper.isNotNull(), F.array_distinct(F.transform(starts, lambda at: F.substring(upper, at, F.lit(n)))))


def wrong_barcode(value: Column, empty_fails: bool = False) -> Column:
    """True where the barcode has no allowed length. Nulls pass; empty text passes unless told otherwise."""
    text = value.cast("string")
    wrong = ~F.char_length(text).isin(*C.BARCODE_LENGTHS)
    if not empty_fails:
        wrong = wrong & (text != "")
    return F.coalesce(wrong, F.lit(False))


def parse_day(text: Column) -> Column:
    """A year-month-day text as a date, null where it is no such day."""
    shape = r"^[0-9]{4}-(1[0-2]|0?[1-9])-(3[01]|[12][0-9]|0?[1-9]| [1-9])\z"
    return F.when(
        text.rlike(shape) & ~text.startswith("0000"), F.replace(text, F.lit("- "), F.lit("-")).try_cast("date")
    )


def year_out_of_range(day: Column) -> Column:
    year = F.year(day)
    return (year != C.OPEN_YEAR) & ~year.between(C.FIRST_YEAR, C.LAST_YEAR)


def wrong_day(text: Column) -> Column:
    """True where a non-empty text is no day or lies outside the accepted years."""
    bad = F.coalesce(year_out_of_range(parse_day(text)), F.lit(True))
    return F.coalesce((text != "") & bad, F.lit(False))


def repair_cell(text: Column, corrections: Mapping[str, str] = C.CELL_CORRECTIONS) -> Column:
    """Replace a whole damaged cell (one holding ``?``) that the dictionary knows."""
    known = F.create_map(*[F.lit(part) for pair in corrections.items() for part in pair])
    return F.when(text.contains("?"), F.coalesce(known[text], text)).otherwise(text)


def describe(item: Column, local_brand: Column, global_brand: Column) -> Column:
    """The text that describes an item; empty where any part is missing."""
    return F.coalesce(
        F.concat(
            F.lit("Description du produit: "), item,
            F.lit("local_brand_name: "), local_brand,
            F.lit(", global_brand_name: "), global_brand,
        ),
        F.lit(""),
    )


def level_path(levels: Sequence[Column]) -> Column:
    """Levels joined with `` > ``; a missing level stays as an empty step."""
    return F.concat_ws(" > ", *[F.coalesce(level, F.lit("")) for level in levels])

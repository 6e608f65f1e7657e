"""Results depend on these exact words, numbers and names."""

from __future__ import annotations

# Cell contents (after upper-casing and trimming) that mean "no value".
NULL_WORDS = ("", "NULL", "N/A", "NAN", "NA", "N.A!")

# Brand cells that mean "no brand"; compared exactly, after text cleaning.
MISSING_BRANDS = (
    "AUTRES MARQUES", "OTHER BRANDS", "AUTRES",
    "SANS MARQUE", "SANS MARQUES", "SANS MARQUES.", "SANS MARQUE.", "REFS.SANS MARQUE", "SANS MARQUE CORA",
    "CET", "MN", "\"1\"",
    "NO NAME", "PP NO NAME", "UNKNOWN", "?",
    "SANS", "SANS.", "SAN",
)

# Words dropped from a brand to find its root. Entries of two words never equal a single token.
NOISE_TOKENS = (
    "PEM", "LOCAL", "PERM", "LIGNE DE", "NUIT", "RIST", "S/VET", "MN", "PROMOCASH", "IMPORT", "NET", "LS", "NO NAME",
)

# Brands that win whenever they occur inside a brand cell.
VERIFIED_BRANDS = ("PETIT BATEAU",)

BARCODE_LENGTHS = (7, 8, 10, 13)
FIRST_YEAR, LAST_YEAR, OPEN_YEAR = 1963, 2100, 9999

# Reasons written to the excluded rows.
ROW_REASON = "all_line_duplicate"
KEY_REASON = "primary_key_duplicate"
BARCODE_REASON = "wrong_barcode_length"
DATE_REASON = "wrong_date"

GLOBAL_LEVELS = (
    "hierarchy_level1_desc",
    "global_hierarchy_level2_desc",
    "global_hierarchy_level3_desc",
    "global_hierarchy_level4_desc",
    "global_hierarchy_level5_desc",
    "global_hierarchy_level6_desc",
)
LOCAL_LEVELS = (
    "hierarchy_level1_desc",
    "local_hierarchy_level2_desc",
    "local_hierarchy_level3_desc",
    "local_hierarchy_level4_desc",
    "local_hierarchy_level5_desc",
    "local_hierarchy_level6_desc",
)
BRAND_COLUMNS = ("local_brand_name", "global_brand_name")

UNKNOWN_LABEL = "<UNK>"

# Damaged Spanish cinema cells and their repaired text.
CELL_CORRECTIONS = {
    "C?nclave": "Cónclave",
    "El ?ltimo": "El Último",
    "El casopl?": "El casoplón",
    "El d?a que": "El día que",
    "Misi?n": "Misión",
    "Sabidur?a": "Sabiduría",
    "Zo?polis": "Zoópolis",
    "M?ndez ?lvaro": "Méndez Álvaro",
    "Parc Vall?s": "Parc Vallès",
    "Intu Xanad?": "Intu Xanadú",
    "Pr?ncipe P?o": "Príncipe Pío",
    "Bah?a de Santander": "Bahía de Santander",
    "Biograf?a": "Biografía",
    "Acci?n": "Acción",
    "Animaci?n": "Animación",
    "es Una pel?cula de Minecraft": "es Una película de Minecraft",
    "es Bienvenido a la monta?a": "es Bienvenido a la montaña",
    "es C?nclave": "es Cónclave",
    "es El ?ltimo suspiro": "es El Último suspiro",
    "es El casopl?n": "es El casoplón",
    "es El d?a que la tierra explot?: Una pel?cula de L": "es El día que la tierra explotó: Una película de L",
    "es Misi?n Panda en ?frica": "es Misión Panda en África",
    "es Peter Pan: Pesadilla en Nunca Jam?s": "es Peter Pan: Pesadilla en Nunca Jamás",
    "es Sabidur?a y felicidad": "es Sabiduría y felicidad",
    "es The Chosen: La ?tima Cena": "es The Chosen: La Última Cena",
    "es Todo lo que no s?": "es Todo lo que no sé",
    "es Una noche en Zo?polis": "es Una noche en Zoópolis",
}

# Characters that count as white space at the ends of a cell (Unicode White_Space).
EDGE_SPACES = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

"""Which rules and columns apply to which kind of dataset, and where its tables live."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from shelfwise.constants import BRAND_COLUMNS

# Rule names in the order in which they are checked and reported.
RULE_ORDER = ("duplicate_row", "duplicate_key", "barcode_length", "date_format")

ALL_MEMBERS = "all_members"  # every member of a duplicate group is flagged
SURPLUS = "surplus"  # one row per duplicate group survives


@dataclass(frozen=True)
class Profile:
    """Columns to standardise and rules to check for one dataset type."""

    standard_columns: tuple[str, ...]
    rules: tuple[str, ...]


PROFILES: Mapping[str, Mapping[str, Profile]] = {
    ALL_MEMBERS: {
        "supermarket": Profile((*BRAND_COLUMNS, "local_supplier_desc", "global_supplier_desc"), RULE_ORDER),
        "movie": Profile((), ("duplicate_row", "duplicate_key", "date_format")),
    },
    SURPLUS: {
        "supermarket": Profile((), ("duplicate_row", "duplicate_key", "barcode_length")),
        "movie": Profile((), ("duplicate_row", "duplicate_key", "date_format")),
    },
}


def profile(dataset_type: str, flavour: str = ALL_MEMBERS, profiles: Mapping = PROFILES) -> Profile:
    """The profile of a dataset type; an unknown flavour or type is an error, never an empty rule list."""
    try:
        found = profiles[flavour][dataset_type]
    except KeyError:
        raise ValueError(f"no profile for dataset type {dataset_type!r} and flavour {flavour!r}") from None
    return as_profile(found)


def as_profile(raw: Profile | Mapping | None) -> Profile:
    """Accept a Profile or a plain mapping, as loaded from a file; a blank list counts as empty."""
    if isinstance(raw, Profile):
        made = raw
    else:
        raw = raw or {}
        made = Profile(tuple(raw.get("standard_columns") or ()), tuple(raw.get("rules") or ()))
    unknown = set(made.rules) - set(RULE_ORDER)
    if unknown:
        raise ValueError(f"unknown rules: {sorted(unknown)}")
    return made


@dataclass(frozen=True)
class Dataset:
    """Names of the raw, clean and excluded tables and the columns the rules look at."""

    raw: str
    clean: str
    excluded: str
    dataset_type: str = "supermarket"
    primary_keys: Sequence[str] = ("country_id", "barcode")
    barcode_columns: Sequence[str] = ("barcode",)
    date_columns: Sequence[str] = ("non_active_date",)
    brand_columns: Sequence[str] = field(default=BRAND_COLUMNS)

    def table(self, role: str) -> str:
        if role not in ("raw", "clean", "excluded"):
            raise ValueError(f"unknown table role {role!r}: use raw, clean or excluded")
        return getattr(self, role)


def check_declared_parameters(declared: Sequence[str], targets: Sequence[Mapping]) -> None:
    """Every parameter that a target job maps must be declared; otherwise the set-up is wrong."""
    for target in targets:
        for name in (target.get("trigger") or {}).values():
            if name not in declared:
                raise ValueError(f"parameter {name!r} of target {target['id']!r} is not declared")

"""Column-name rules.

The rules are pure functions from a list of names to a list of names; the
DataFrame side applies the result in a single projection (``toDF``), so no
rule costs more than one ``Project`` node however many columns it touches.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame


def underscore_names(names: Sequence[str]) -> list[str]:
    """Blanks become underscores (workbook sheet columns and sheet names)."""
    return [n.replace(" ", "_") for n in names]


def sanitize_names(names: Sequence[str]) -> list[str]:
    """Blank -> ``_``, double quote dropped, ``-`` -> ``_``; empty -> ``col_{i}``."""
    out = []
    for i, name in enumerate(names):
        clean = (name or "").replace(" ", "_").replace('"', "").replace("-", "_")
        out.append(clean if clean else f"col_{i}")
    return out


def dedupe_names(names: Sequence[str]) -> list[str]:
    """Give every copy of a repeated name its 0-based position as suffix.

    Names are compared without regard to case, as Spark resolves them.  If a
    suffixed name is itself taken (``x, y, x, x_0``), the suffix counts up from
    the position until the name is free, so the result is always unique.
    """
    lowered = Counter(n.lower() for n in names)
    taken = {n.lower() for n in names if lowered[n.lower()] == 1}
    out = []
    for i, name in enumerate(names):
        if lowered[name.lower()] == 1:
            out.append(name)
            continue
        k = i
        candidate = f"{name}_{k}"
        while candidate.lower() in taken:
            k += 1
            candidate = f"{name}_{k}"
        taken.add(candidate.lower())
        out.append(candidate)
    return out


def sheet_table_name(sheet: str) -> str:
    """Target table of a workbook sheet: blanks become underscores."""
    return sheet.replace(" ", "_")


def with_names(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Apply a full list of new names in one projection."""
    return df.toDF(*names)


def apply_underscore(df: DataFrame) -> DataFrame:
    return with_names(df, underscore_names(df.columns))


def apply_sanitize(df: DataFrame) -> DataFrame:
    return with_names(df, sanitize_names(df.columns))


def apply_dedupe(df: DataFrame) -> DataFrame:
    return with_names(df, dedupe_names(df.columns))


def writable_names(df: DataFrame) -> DataFrame:
    """Sanitise, then make unique: what a relational target accepts."""
    return with_names(df, dedupe_names(sanitize_names(df.columns)))


def prefix_rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename colliding columns; names not present are ignored.

    ``withColumnsRenamed`` matches names case-insensitively (session default)
    and silently skips absent ones, which is the behaviour wanted here.
    """
    present = {c.lower() for c in df.columns}
    effective = {old: new for old, new in mapping.items() if old.lower() in present}
    return df.withColumnsRenamed(effective) if effective else df

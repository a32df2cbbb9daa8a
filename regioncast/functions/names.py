"""Name repair for area columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The reference's one repair rule.  Any area whose name contains
# the substring gets the full bilingual name.
DEFAULT_NAME_RULES: list[tuple[str, str]] = [
    ("Valle", "Valle d'Aosta / Vallée d'Aoste"),
]


def repaired_name(c: str | Column, rules: Sequence[tuple[str, str]] = DEFAULT_NAME_RULES) -> Column:
    """Column expression: first matching ``(substring, replacement)`` wins."""
    c = F.col(c) if isinstance(c, str) else c
    out = c
    for needle, replacement in reversed(list(rules)):
        out = F.when(c.contains(needle), F.lit(replacement)).otherwise(out)
    return out


def normalise_names(df: DataFrame, col: str = "area",
                    rules: Sequence[tuple[str, str]] = DEFAULT_NAME_RULES) -> DataFrame:
    """Replace ``col`` by its repaired form."""
    return df.withColumn(col, repaired_name(col, rules))

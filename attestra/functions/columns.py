"""Small column helpers used everywhere."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_array(values: Iterable) -> Column:
    return F.array(*[F.lit(v) for v in values])


def lookup(mapping: Mapping, key: Column) -> Column:
    """Literal map lookup; null for an absent or null key."""
    entries = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*entries), key)


def contains_any(text: Column, needles: Iterable[str]) -> Column:
    """True when the text holds any of the literal needles."""
    return text.rlike("|".join(re.escape(n) for n in needles))


def overlaps(tags: Column, values: Iterable[str]) -> Column:
    return F.arrays_overlap(tags, lit_array(values))


def text_of(c: Column | str) -> Column:
    """Null-safe string."""
    return F.coalesce(as_col(c).cast("string"), F.lit(""))


def blank_to_null(c: Column | str) -> Column:
    c = F.trim(as_col(c))
    return F.when(c != "", c)


def trim_spaces(c: Column | str) -> Column:
    """Both ends without space characters of any script (no tabs or line ends), as SQL engines with Unicode trim."""
    return F.regexp_replace(as_col(c), r"\A\p{Zs}+|(?<!\p{Zs})\p{Zs}++\z", "")


def clamp(c: Column, low: float, high: float) -> Column:
    """Bounded value; null stays null (least and greatest skip nulls)."""
    return F.when(c.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), c)))


def case(*branches: tuple[Column, Column | str], default: Column | str | None = None) -> Column:
    """First-match CASE WHEN from (condition, value) pairs."""
    out = None
    for cond, value in branches:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out if default is None else out.otherwise(default if isinstance(default, Column) else F.lit(default))

"""Field access on open-shape JSON held as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from attestra.functions.columns import as_col, blank_to_null


def field(v: Column | str, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(as_col(v), f"$.{path}", kind)


def text_field(v: Column | str, path: str) -> Column:
    """Trimmed text of a field that is a JSON string and not blank."""
    sub = F.try_variant_get(as_col(v), f"$.{path}", "variant")
    return F.when(F.schema_of_variant(sub) == "STRING", blank_to_null(field(v, path)))


def any_field(v: Column | str, path: str) -> Column:
    """Text of any scalar field that is not blank."""
    s = field(v, path)
    return F.when(F.trim(s) != "", s)


def list_field(v: Column | str, path: str) -> Column:
    return field(v, path, "array<string>")

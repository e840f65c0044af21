"""VARIANT helpers that keep absent, null and zero apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def at(variant: Column, path: str, kind: str = "variant") -> Column:
    """Value under ``path``; null when absent or not castable."""
    return F.try_variant_get(variant, path, kind)


def is_present(variant: Column, path: str) -> Column:
    """Key exists, whatever its value."""
    return at(variant, path).isNotNull()


def is_json_null(variant: Column, path: str) -> Column:
    """Key exists and holds JSON null."""
    return F.coalesce(F.is_variant_null(at(variant, path)), F.lit(False))


def has_value(variant: Column, path: str) -> Column:
    """Key exists and is not null."""
    return is_present(variant, path) & ~is_json_null(variant, path)


def has_type(variant: Column, *names: str) -> Column:
    """The value is one of the VARIANT types ``names``."""
    return F.coalesce(F.schema_of_variant(variant).isin(*names), F.lit(False))

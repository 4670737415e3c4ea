"""Paths into VARIANT values of unsettled layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F, types as T

from goldspine.functions.collections import sorted_labels
from goldspine.functions.numbers import to_integer, to_double

Path = Sequence[str]


def json_path(path: Path) -> str:
    return "$" + "".join(f"['{key}']" for key in path)


def at(value: Column, path: Path) -> Column:
    """VARIANT at ``path``; null where a step is absent or not an object."""
    return F.try_variant_get(value, json_path(path), "variant")


def kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def is_object(value: Column) -> Column:
    return F.coalesce(kind(value).startswith("OBJECT"), F.lit(False))


def is_array(value: Column) -> Column:
    return F.coalesce(kind(value).startswith("ARRAY"), F.lit(False))


def is_text(value: Column) -> Column:
    return F.coalesce(kind(value) == "STRING", F.lit(False))


def is_boolean(value: Column) -> Column:
    return F.coalesce(kind(value) == "BOOLEAN", F.lit(False))


def first_of(found: Sequence[Column]) -> Column:
    """First of several VARIANT values that is not null, ``""``, ``[]`` or ``{}``."""
    return F.coalesce(*[F.when(~F.to_json(one).isin("null", '""', "[]", "{}"), one) for one in found])


def first_present(value: Column, paths: Sequence[Path]) -> Column:
    """First VARIANT among ``paths`` that is present."""
    return first_of([at(value, path) for path in paths])


def text_of(value: Column, its_kind: Column) -> Column:
    """Text of a scalar of the given kind; null for an object or an array."""
    nested = F.coalesce(its_kind.startswith("OBJECT") | its_kind.startswith("ARRAY"), F.lit(False))
    return F.when(~nested, F.try_variant_get(value, "$", "string"))


def scalar_text(value: Column) -> Column:
    return text_of(value, kind(value))


def first_text(value: Column, paths: Sequence[Path]) -> Column:
    return scalar_text(first_present(value, paths))


def first_item(value: Column) -> Column:
    """The first of a list, or the value itself."""
    return F.when(is_array(value), F.try_variant_get(value, "$[0]", "variant")).otherwise(value)


def named(value: Column, field: str) -> Column:
    """``field`` of an object, or the value itself."""
    return F.when(is_object(value), at(value, (field,))).otherwise(value)


def first_item_name(value: Column, paths: Sequence[Path], field: str = "name") -> Column:
    """A label given as text, as an object with ``field``, or as a list of either."""
    return scalar_text(named(first_item(first_present(value, paths)), field))


def measure(value: Column, unit: str) -> Column:
    """Unwrap ``{unit: number, ...}``; a bare value is itself."""
    return named(value, unit)


def integer(value: Column, its_kind: Column | None = None) -> Column:
    """``its_kind``: the value's kind where it is at hand as a column."""
    its_kind = kind(value) if its_kind is None else its_kind
    number = F.round(F.try_variant_get(value, "$", "decimal(38,6)")).try_cast("bigint")
    return F.when(F.coalesce(its_kind == "STRING", F.lit(False)), to_integer(text_of(value, its_kind), T.StringType())).otherwise(number)


def double(value: Column, its_kind: Column | None = None) -> Column:
    its_kind = kind(value) if its_kind is None else its_kind
    number = F.try_variant_get(value, "$", "double")
    return F.when(F.coalesce(its_kind == "STRING", F.lit(False)), to_double(text_of(value, its_kind), T.StringType())).otherwise(number)


def labels(value: Column, field: str) -> Column:
    """Sorted distinct labels of a collection.

    An object gives its keys. A list gives ``field`` of its objects and its
    text entries; anything that is not text is skipped. Else empty.
    """
    entries = F.try_variant_get(value, "$", "array<variant>")
    picked = F.transform(entries, lambda e: F.when(is_object(e), at(e, (field,))).otherwise(e))
    texts = F.transform(
        F.filter(picked, is_text), lambda e: F.try_variant_get(e, "$", "string")
    )
    keys = F.map_keys(F.try_variant_get(value, "$", "map<string,variant>"))
    empty = F.array().cast("array<string>")
    return (
        F.when(is_object(value), F.coalesce(F.array_sort(keys), empty))
        .when(is_array(value), F.coalesce(sorted_labels(texts), empty))
        .otherwise(empty)
    )

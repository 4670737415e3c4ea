"""Which source a value came from."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F


def survivor(columns: Sequence[str], available: Sequence[str], dtype: str) -> Column:
    """First non-null of ``columns`` that exist; an empty string counts as a value."""
    existing = [F.col(f"`{name}`") for name in columns if name in set(available)]
    return F.coalesce(*existing).cast(dtype) if existing else F.lit(None).cast(dtype)


def contributing(presence: Mapping[str, Column], separator: str = "|") -> Column:
    """Names of the sources present, in the mapping's order."""
    return F.concat_ws(separator, *[F.when(seen, F.lit(name)) for name, seen in presence.items()])


def contributor_count(presence: Mapping[str, Column]) -> Column:
    total = F.lit(0).cast("bigint")
    for seen in presence.values():
        total = total + seen.cast("bigint")
    return total

"""Reading published tables: search, pages, single rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from goldspine import schema as S
from goldspine.functions.text import contains_ignoring_case
from goldspine.operators.joins import lookup

# Page bounds of the read interface.
DEFAULT_LIMIT = 100
MAX_LIMIT = 500
MAX_SEARCH = 150


def check_page(limit: int, offset: int = 0) -> None:
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be in 1..{MAX_LIMIT}")
    if offset < 0:
        raise ValueError("offset must not be negative")


def read_model(df: DataFrame, table: str) -> DataFrame:
    """The public columns of a published table, in order."""
    ddl = S.AUDIT if table == "data_load_audit" else S.STAR_TABLES[table]
    return df.select(*S.schema(ddl).fieldNames())


def search(df: DataFrame, column: str, term: str) -> DataFrame:
    """Rows whose ``column`` contains ``term`` in any case."""
    if not 1 <= len(term) <= MAX_SEARCH:
        raise ValueError(f"search must have 1..{MAX_SEARCH} characters")
    return df.where(contains_ignoring_case(F.col(column), term))


def list_page(
    df: DataFrame,
    id_column: str,
    limit: int = DEFAULT_LIMIT,
    offset: int = 0,
    search_column: str | None = None,
    term: str | None = None,
) -> DataFrame:
    """One page in id order. Deep pages cost their offset; see ``page_after`` and ``sinks.clustered.page_at``."""
    check_page(limit, offset)
    rows = search(df, search_column, term) if term and search_column else df
    return rows.orderBy(id_column).offset(offset).limit(limit)


def page_after(df: DataFrame, id_column: str, last_id=None, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """The page following ``last_id``; the bound is pushed to the scan at any depth."""
    check_page(limit)
    rows = df if last_id is None else df.where(F.col(id_column) > F.lit(last_id))
    return rows.orderBy(id_column).limit(limit)


class NotFound(LookupError):
    """No row has the requested id."""


def get(df: DataFrame, id_column: str, value) -> DataFrame:
    """The row with this id (the filter reaches the scan); raises if absent."""
    found = df.where(F.col(id_column) == F.lit(value))
    if found.isEmpty():
        raise NotFound(f"{id_column} {value}")
    return found


def get_many(df: DataFrame, ids: DataFrame, id_column: str) -> DataFrame:
    """Every requested id with its row and a ``found`` flag; ids may repeat.

    The table is reduced to requested rows first, so no more than these are joined.
    """
    wanted = ids.select(id_column).distinct()
    flagged = df.join(wanted, id_column, "left_semi").withColumn("found", F.lit(True))
    joined = lookup(ids.select(id_column), flagged, [id_column], "left")
    return joined.withColumn("found", F.coalesce("found", F.lit(False)))


def most_recent(df: DataFrame, time: str, limit: int = DEFAULT_LIMIT, offset: int = 0, tie_break: tuple[str, ...] = ()) -> DataFrame:
    """Newest rows first."""
    check_page(limit, offset)
    order = [F.col(time).desc_nulls_first(), *[F.col(c).desc() for c in tie_break]]
    return df.orderBy(*order).offset(offset).limit(limit)

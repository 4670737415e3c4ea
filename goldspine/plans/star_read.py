"""Reading the published tables: pages, searches, single rows, loads."""

from __future__ import annotations

from pyspark.sql import DataFrame

from goldspine.operators import access
from goldspine.plans.star_edit import IDS
from goldspine.plans.star_store import StarStore
from goldspine.sinks.clustered import page_at, write_clustered

# The column each table is searched by.
SEARCH = {"region": "region_name", "subregion": "subregion_name", "country": "country_name"}


def list_rows(
    store: StarStore, table: str, limit: int = access.DEFAULT_LIMIT, offset: int = 0, term: str | None = None
) -> DataFrame:
    """One page in id order, optionally of the rows whose name contains ``term``."""
    rows = access.read_model(store.table(table), table)
    return access.list_page(rows, IDS[table], limit, offset, SEARCH.get(table), term)


def next_rows(store: StarStore, table: str, last_id: int | None = None, limit: int = access.DEFAULT_LIMIT) -> DataFrame:
    """The page after ``last_id``, at the same cost however deep."""
    return access.page_after(access.read_model(store.table(table), table), IDS[table], last_id, limit)


def lay_out(store: StarStore, table: str, path: str) -> str:
    """Write the table as it stands for reads by place: ``seek_rows`` then costs the same at any offset."""
    return write_clustered(access.read_model(store.table(table), table), IDS[table], path)


def seek_rows(store: StarStore, path: str, limit: int = access.DEFAULT_LIMIT, offset: int = 0) -> DataFrame:
    """The page that ``list_rows`` gives, of a table that ``lay_out`` wrote."""
    return page_at(store.spark, path, limit, offset)


def get_row(store: StarStore, table: str, row_id: int) -> DataFrame:
    return access.get(access.read_model(store.table(table), table), IDS[table], row_id)


def list_loads(store: StarStore, limit: int = access.DEFAULT_LIMIT, offset: int = 0) -> DataFrame:
    """Load audits, newest first."""
    return access.most_recent(access.read_model(store.audit(), "data_load_audit"), "started_at", limit, offset, ("load_id",))


def get_load(store: StarStore, load_id: str) -> DataFrame:
    return access.get(store.audit(), "load_id", load_id)

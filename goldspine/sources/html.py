"""Rows of the population table of stored web pages."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from goldspine import schema as S
from goldspine.functions.numbers import grouped_integer
from goldspine.functions.text import drop_footnotes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# HTML elements that have no end tag, and those whose text is not shown.
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link",
    "menuitem", "meta", "param", "source", "track", "wbr", "basefont", "bgsound",
    "command", "frame", "image", "isindex", "nextid", "spacer",
}
HIDDEN = {"script", "style", "template"}
# Words that mark the two columns, and the class of a candidate table.
NAME_WORDS = ("country", "location")
VALUE_WORD = "population"
TABLE_CLASS = "wikitable"
# Found rows leave a task in batches of about so many.
ROWS = 10_000
CELLS = "position int, name_cell string, value_cell string"


class _Table:
    """What is kept of an open candidate: the wanted cells of its rows, once its first row tells which these are."""

    __slots__ = ("rows", "found", "fits", "begun", "waiting", "ended")

    def __init__(self):
        self.rows, self.found, self.fits, self.begun, self.waiting, self.ended = [], None, None, 0, [], False

    def begin_row(self):
        self.begun += 1
        return self.begun - 1

    def end_row(self, place, cells):
        if place == 0:
            labels = [text.lower() for text in cells]
            name = next((i for i, t in enumerate(labels) if any(word in t for word in NAME_WORDS)), None)
            value = next((i for i, t in enumerate(labels) if VALUE_WORD in t), None)
            self.fits = name is not None and value is not None
            if self.fits:
                self.found = (name, value)
                for row in self.waiting:
                    self.end_row(*row)
            self.waiting = []
        elif self.fits is None:
            self.waiting.append((place, cells))
        elif self.fits and len(cells) > max(self.found):
            self.rows.append((place - 1, *[cells[i] for i in self.found]))

    def end(self):
        self.fits, self.ended = bool(self.fits), True
        # A row inside another has ended before it.
        self.rows.sort()


class _Found(Exception):
    """The table that is wanted has ended; nothing after it matters."""


class _TableStream(HTMLParser):
    """Reads a page tag by tag and keeps its open elements and candidate tables, never a tree.

    Elements nest as written; an end tag closes the nearest open element of its
    name, and what is open inside it. A cell belongs to the row it stands in
    directly, a row to every table around it.
    """

    def __init__(self, table_id):
        super().__init__(convert_charrefs=True)
        self.table_id = table_id
        self.preferred = None  # the first table with the id
        self.classed = []  # candidates of the class, as they begin, without those ruled out
        self.open, self.count = [], {}  # (name, what it stands for) and how many of each name
        self.tables, self.cells, self.hidden = [], [], []
        self.pieces = []  # text since the last change of the tree

    def best(self, page_ends=False):
        """The rows of the wanted table, as soon as it is known and has ended."""
        while self.classed and self.classed[0].fits is False:
            self.classed.pop(0)
        first = self.preferred
        if first is None and self.table_id and not page_ends:
            return None
        if first is None or first.fits is False:
            first = self.classed[0] if self.classed else None
        return first.rows if first is not None and first.ended else None

    def flush(self):
        if self.pieces:
            text = "".join(self.pieces).strip()
            self.pieces.clear()
            if text:
                shown = self.hidden[-1] if self.hidden else -1
                for depth, parts in reversed(self.cells):
                    if depth < shown:
                        break
                    parts.append(text)

    def candidate(self, attrs):
        attrs = dict(attrs)
        table = None
        if self.table_id and self.preferred is None and attrs.get("id") == self.table_id:
            table = self.preferred = _Table()
        elif TABLE_CLASS in (attrs.get("class") or "").split() and not (self.classed and self.classed[0].fits):
            table = _Table()
            self.classed.append(table)
        return table

    def begin(self, tag, attrs):
        """What the element stands for: a table, a row, a cell or nothing."""
        self.flush()
        if tag == "table":
            return self.candidate(attrs)
        if tag == "tr" and self.tables:
            return [(table, table.begin_row()) for table in self.tables], []
        if tag in ("td", "th") and self.open and self.open[-1][0] == "tr" and self.open[-1][1]:
            self.open[-1][1][1].append([])
            return self.open[-1][1][1][-1]
        return None

    def finish(self, tag, thing):
        if thing is None:
            return
        if tag == "table":
            thing.end()
            if self.best() is not None:
                raise _Found
        elif tag == "tr":
            places, cells = thing
            cells = [" ".join(parts) for parts in cells]
            for table, place in places:
                table.end_row(place, cells)

    def handle_starttag(self, tag, attrs):
        thing = self.begin(tag, attrs)
        if tag in VOID:
            return
        if thing is not None and tag == "table":
            self.tables.append(thing)
        elif thing is not None and tag != "tr":
            self.cells.append((len(self.open), thing))
        if tag in HIDDEN:
            self.hidden.append(len(self.open))
        self.open.append((tag, thing))
        self.count[tag] = self.count.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.finish(tag, self.begin(tag, attrs))

    def handle_endtag(self, tag):
        if self.count.get(tag):
            self.flush()
            while self.close_last() != tag:
                pass

    def close_last(self):
        tag, thing = self.open.pop()
        self.count[tag] -= 1
        if tag in HIDDEN:
            self.hidden.pop()
        if thing is not None and tag == "table":
            self.tables.pop()
        elif thing is not None and tag != "tr":
            self.cells.pop()
        self.finish(tag, thing)
        return tag

    def handle_data(self, data):
        if self.cells:
            self.pieces.append(data)

    def read(self, html):
        try:
            self.feed(html)
            self.close()
            self.flush()
            while self.open:
                self.close_last()
        except _Found:
            pass
        return self.best(page_ends=True) or []


def table_rows(html, table_id=None):
    """(position, name cell, value cell) of the first table that has both columns.

    A table with ``table_id`` is tried first, then those of the candidate class.
    """
    return _TableStream(table_id).read(html)


class TableNotFound(ValueError):
    """No page held a table with the wanted columns."""


def _tables_of(schema: pa.Schema, table_id: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The columns before the last, which is the page, and the cells of each row found in it."""
        for batch in batches:
            kept, names = batch.columns[:-1], batch.schema.names[:-1] + schema.names
            source, rows = [], []
            for place, page in enumerate(batch.column(batch.num_columns - 1)):
                found = table_rows(page.as_py(), table_id)
                source += [place] * len(found)
                rows += found
                if rows and (len(rows) >= ROWS or place == batch.num_rows - 1):
                    taken = [c.take(pa.array(source)) for c in kept]
                    cells = [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)]
                    yield pa.RecordBatch.from_arrays(taken + cells, names=names)
                    source, rows = [], []

    return run


def raw_rows(pages: DataFrame, html: str, *keep: str, table_id: str | None = None) -> DataFrame:
    """Cell texts of each page's population table.

    Pages that cannot hold one never leave the JVM: those without a table, or
    without the value column's word (written plainly or as character codes).
    The others are read as a stream of tags, batch by batch, up to the end of
    the table that is wanted; a task holds a batch of pages and one page's tables.
    """
    text = F.col(f"`{html}`")
    tabled = pages.where(text.ilike("%<table%") & (text.ilike(f"%{VALUE_WORD}%") | text.contains("&#")))
    # Plain names inside the task: those kept may be any.
    read = tabled.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate([*keep, html])])
    schema = T.StructType([*read.schema.fields[:-1], *S.schema(CELLS).fields])
    cells = pa.schema([("position", pa.int32()), ("name_cell", pa.string()), ("value_cell", pa.string())])
    return read.mapInArrow(_tables_of(cells, table_id), schema).toDF(*keep, *cells.names)


def clean_rows(raw: DataFrame, *keep: str) -> DataFrame:
    """Names without footnotes, exact counts, and why a row is left out (null: kept)."""
    cleaned = raw.select(
        *keep,
        "position",
        drop_footnotes(F.col("name_cell")).alias("country_name"),
        grouped_integer(F.col("value_cell")).alias("population_scraped"),
    )
    rejected = (
        F.when(F.coalesce(F.col("country_name"), F.lit("")) == "", "no name")
        .when(F.lower("country_name") == "world", "total row")
        .when(F.col("population_scraped").isNull(), "not a number")
    )
    return cleaned.withColumn("rejected", rejected)


def scraped_records(pages: DataFrame, html: str, url: str, table_id: str | None = None) -> DataFrame:
    """The kept rows in the published record layout."""
    cleaned = clean_rows(raw_rows(pages, html, url, table_id=table_id), url)
    return cleaned.where(F.col("rejected").isNull()).select(
        "country_name",
        "population_scraped",
        F.lit("scraping").alias("source_type"),
        F.col(url).alias("source_url"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("extracted_at"),
    )


def require_records(records: DataFrame) -> DataFrame:
    if records.isEmpty():
        raise TableNotFound("no table with a country and a population column gave a valid row")
    return records

"""Batches of creates and replacements, split into accepted and rejected rows."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from goldspine.operators.components import components, least_labels
from goldspine.operators.joins import lookup
from goldspine.operators.quality import Rule, with_reasons
from goldspine.operators.upsert import CHANGE, upsert
from goldspine.sinks.staging import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

REASON = "reason"


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: DataFrame
    parent_key: str


def create_rows(
    batch: DataFrame,
    existing: DataFrame,
    unique: Sequence[Sequence[str]],
    ordinal: str,
    rules: Sequence[Rule] = (),
    foreign_keys: Sequence[ForeignKey] = (),
) -> DataFrame:
    """``batch`` with a ``reason`` column: null where the row may be inserted.

    Rows are judged as if created one after another in ``ordinal`` order
    (unique per row): by the rules, by their references, then by uniqueness
    against stored rows and against the rows accepted before them.
    """
    judged = with_reasons(batch, rules, REASON) if rules else batch.withColumn(REASON, F.lit(None).cast("string"))
    for fk in foreign_keys:
        parents = fk.parent.select(F.col(fk.parent_key).alias(fk.column)).distinct().withColumn("_parent", F.lit(True))
        judged = lookup(judged, parents, [fk.column], "left")
        unknown = F.col(fk.column).isNotNull() & F.col("_parent").isNull()
        judged = judged.withColumn(
            REASON, F.coalesce(REASON, F.when(unknown, F.lit(f"unknown {fk.column}")))
        ).drop("_parent")
    if len(unique) == 1:
        return _reject_repeats(judged, existing, list(unique[0]), ordinal)
    return _settle_in_order(judged, existing, [list(keys) for keys in unique], ordinal)


def _label(keys: Sequence[str]) -> str:
    return "conflict on " + ", ".join(keys)


def _all_set(keys: Sequence[str]) -> Column:
    return reduce(lambda left, right: left & right, [F.col(key).isNotNull() for key in keys])


def _reject_repeats(judged: DataFrame, existing: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    # One winner per key, joined back by the unique ordinal: a repeated key is
    # reduced inside the map tasks and never gathered.
    candidates = judged.where(F.col(REASON).isNull()).dropna(subset=keys)
    winners = candidates.groupBy(*keys).agg(F.min(ordinal).alias(ordinal))
    winners = winners.join(existing.select(*keys).distinct(), keys, "left_anti").select(
        ordinal, F.lit(True).alias("_wins")
    )
    loses = F.col(REASON).isNull() & F.col("_wins").isNull() & _all_set(keys)
    return (
        judged.join(winners, ordinal, "left")
        .withColumn(REASON, F.coalesce(REASON, F.when(loses, F.lit(_label(keys)))))
        .drop("_wins")
    )


def _first_on_all_keys(undecided: DataFrame, unique: list[list[str]], ordinal: str) -> tuple[DataFrame, DataFrame]:
    """(rows that come first on each of their keys, rows that none of these beats)."""
    winners = undecided
    for keys in unique:
        first = undecided.dropna(subset=keys).groupBy(*keys).agg(F.min(ordinal).alias(ordinal)).select(ordinal)
        free = undecided.where(~_all_set(keys)).select(ordinal)
        winners = winners.join(first.unionAll(free), ordinal, "left_semi")
    winners = stage(winners, "winners")
    rest = undecided.join(winners.select(ordinal), ordinal, "left_anti")
    for keys in unique:
        rest = lookup(rest, winners.select(*keys).dropna(), keys, "left_anti").select(undecided.columns)
    return winners.select(undecided.columns), stage(rest, "undecided")


def _settler(unique: list[list[str]], ordinal: str):
    def settle(rows: pa.Table) -> pa.Table:
        """The rows of whole components one after another: a row is taken if all its keys are free."""
        columns = [list(zip(*[rows.column(key).to_pylist() for key in keys])) for keys in unique]
        seen: list[set] = [set() for _ in unique]
        taken = []
        for i in pc.sort_indices(rows.column(ordinal)).to_pylist():
            mine = [(held, column[i]) for held, column in zip(seen, columns) if None not in column[i]]
            if not any(key in held for held, key in mine):
                taken.append(i)
                for held, key in mine:
                    held.add(key)
        return rows.select([ordinal]).take(pa.array(taken, pa.int64()))

    return settle


#: Rows of a range of ordinals whose links one task contracts at once.
PIECE_ROWS = 1 << 18


def _placer(columns: list[str], names: list[str]):
    def placed(rows: pa.Table) -> pa.RecordBatch:
        # Every row has a first name; the others are linked with it.
        first = rows.column(names[0]).to_numpy()
        links = [(first, first)]
        for name in names[1:]:
            held = rows.column(name).is_valid().to_numpy()
            links.append((first[held], rows.column(name).drop_null().to_numpy()))
        nodes, label = least_labels(*map(np.concatenate, zip(*links)))
        centre = pa.array(nodes[label[np.searchsorted(nodes, first)]])
        return rows.select(columns).append_column("_centre", centre).combine_chunks().to_batches()[0]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= 2 * PIECE_ROWS:
                yield placed(pa.Table.from_batches(held))
                held, rows = [], 0
        if rows:
            yield placed(pa.Table.from_batches(held))

    return place


def _settle_components(undecided: DataFrame, unique: list[list[str]], ordinal: str, most: int) -> tuple[DataFrame, DataFrame]:
    """(ordinals accepted in components of up to ``most`` rows, the rows of larger components).

    Rows are connected by the keys they share. Hashes name the keys; two that
    meet only join components that could be apart. After the first round a row is
    left only behind an earlier one, so a range of ordinals holds whole stretches
    of a chain: each range is reduced to its own components in a task, and only
    those that share a key across ranges are links of the graph.
    """
    rows = undecided.count()
    named = [F.when(_all_set(keys), F.xxhash64(F.lit(k), *keys)) for k, keys in enumerate(unique)]
    names = ["_first", *[f"_name{k}" for k in range(len(unique))]]
    first = F.coalesce(*named, F.xxhash64(F.lit("row"), ordinal))
    # Hashes do not compress, so they are made behind the shuffle.
    ranges = undecided.repartitionByRange(-(-rows // PIECE_ROWS), ordinal).sortWithinPartitions(ordinal)
    ranges = ranges.select("*", *[c.alias(n) for c, n in zip([first, *named], names)])
    layout = T.StructType([*undecided.schema.fields, T.StructField("_centre", T.LongType())])
    placed = stage(ranges.mapInArrow(_placer(undecided.columns, names), layout), "settle")
    held = reduce(DataFrame.unionAll, [
        placed.dropna(subset=keys).select(name.alias("key"), "_centre") for keys, name in zip(unique, named)
    ])
    shared = held.groupBy("key").agg(F.min("_centre").alias("b"), F.max("_centre").alias("_last")).where("b <> _last")
    # Written first: a few shared keys are then broadcast, and no row moves for them.
    links = held.join(stage(shared.select("key", "b"), "settle-shared"), "key").select(F.col("_centre").alias("a"), "b")
    joined = components(links)
    placed = placed.join(joined, F.col("_centre") == F.col("node"), "left").withColumn("component", F.coalesce("component", "_centre")).drop("node", "_centre")
    sizes = stage(placed.groupBy("component").agg(F.count("*").alias("_n")), "settle-sizes")
    large = sizes.where(F.col("_n") > most).select("component")
    buckets = max(int(undecided.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // most))
    small = placed.join(large, "component", "left_anti").withColumn("_bucket", F.pmod(F.xxhash64("component"), F.lit(buckets))).drop("component")
    accepted = small.groupBy("_bucket").applyInArrow(_settler(unique, ordinal), T.StructType([undecided.schema[ordinal]]))
    return accepted, placed.join(large, "component", "left_semi").select(undecided.columns)


#: Rows of a component that one task settles; larger ones go on by rounds.
COMPONENT_ROWS = 100_000


def _settle_in_order(
    judged: DataFrame, existing: DataFrame, unique: list[list[str]], ordinal: str, most: int = COMPONENT_ROWS
) -> DataFrame:
    """Several constraints: a row beaten on one must free its other keys.

    A first round accepts the rows that come first on all their keys and drops
    those they beat, so no key is shared by many rows any more. What is left
    falls into components of rows that block each other. Their rows are settled
    in order inside a task, many components to a task; only components of more
    than ``most`` rows go on by rounds. A reason names the first constraint of
    which a stored row, or an accepted one before it, holds the row's key.
    """
    columns = list(dict.fromkeys(key for keys in unique for key in keys))
    sound = judged.where(F.col(REASON).isNull()).select(ordinal, *columns)
    undecided = sound
    for keys in unique:
        undecided = lookup(undecided, existing.select(*keys).dropna().distinct(), keys, "left_anti").select(ordinal, *columns)
    winners, undecided = _first_on_all_keys(stage(undecided, "undecided"), unique, ordinal)
    accepted = [winners.select(ordinal)]
    if not undecided.isEmpty():
        settled, undecided = _settle_components(undecided, unique, ordinal, most)
        accepted.append(stage(settled, "settled"))
        while not undecided.isEmpty():
            winners, undecided = _first_on_all_keys(undecided, unique, ordinal)
            accepted.append(winners.select(ordinal))
    won = stage(sound.join(reduce(DataFrame.unionAll, accepted), ordinal, "left_semi"), "accepted")
    reasons = sound.join(won.select(ordinal), ordinal, "left_anti").withColumn("_why", F.lit(None).cast("string"))
    for keys in unique:
        stored = existing.select(*keys).dropna().distinct().select(*keys, F.lit(None).cast(sound.schema[ordinal].dataType).alias("_by"))
        holders = stored.unionAll(won.dropna(subset=keys).select(*keys, F.col(ordinal).alias("_by"))).withColumn("_held", F.lit(True))
        blocked = F.col("_held") & (F.col("_by").isNull() | (F.col("_by") < F.col(ordinal)))
        reasons = lookup(reasons, holders, keys).select(
            ordinal, *columns, F.coalesce("_why", F.when(blocked, F.lit(_label(keys)))).alias("_why")
        )
    return judged.join(reasons.select(ordinal, "_why"), ordinal, "left").withColumn(REASON, F.coalesce(REASON, "_why")).drop("_why")


#: Pointers may become so many times as many before they are no longer doubled.
_MOST_POINTERS = 4


def _reached(pointers: DataFrame, refused: DataFrame) -> DataFrame:
    """``row`` of all rows from which a refused one (``row``) is reached over ``pointers`` (``row, to``).

    Pointer doubling: in a round each row whose target is refused turns into a
    refused one, and the others point where their targets point. After n rounds
    all ways of up to 2**n steps have been followed. A row with several pointers
    may come by more and more of them; where that happens, rounds go on with the
    pointers as they are, a step at a time. A round is one written table, in
    which a pointer to nothing marks a refused row.
    """
    start = pointers = stage(pointers, "pointers")
    most, doubling = _MOST_POINTERS * pointers.count(), True
    gone, found = refused, []
    while True:
        met = pointers.join(gone.select(F.col("row").alias("to")), "to", "left_semi").select("row", F.lit(None).cast(pointers.schema["to"].dataType).alias("to"))
        after = met
        if doubling:
            beyond = pointers.select(F.col("row").alias("_row"), F.col("to").alias("row")).join(pointers, "row")
            after = met.unionAll(beyond.select(F.col("_row").alias("row"), "to").where(F.col("row") != F.col("to")))
        after = stage(after.distinct(), "pointers")
        hit = after.where(F.col("to").isNull()).select("row")
        rows, marks = after.agg(F.count("*"), F.count_if(F.col("to").isNull())).first()
        if not marks:
            return reduce(DataFrame.unionAll, found) if found else refused.limit(0)
        found.append(hit)
        gone = gone.unionAll(hit)
        doubling = doubling and rows <= most
        left = after.where(F.col("to").isNotNull()) if doubling else start
        pointers = left.join(reduce(DataFrame.unionAll, found), "row", "left_anti")


def judge_replacements(
    batch: DataFrame,
    existing: DataFrame,
    unique: Sequence[Sequence[str]],
    id_column: str,
    rules: Sequence[Rule] = (),
    foreign_keys: Sequence[ForeignKey] = (),
) -> DataFrame:
    """``batch`` with a ``reason`` column: null where the stored row of that id may be replaced.

    ``batch`` has only stored ids, each once. Rows are judged by the rules,
    their references, the stored rows that are not to be replaced and each
    other, in the order of their ids. A rejected row keeps its stored values,
    and these may stand in the way of others: a row points at the rows of the
    batch that hold the keys it wants, and whoever reaches a rejected row is
    rejected as well, for the first constraint of which a rejected row holds
    the key.
    """
    staying = existing.join(batch.select(id_column), id_column, "left_anti")
    judged = stage(create_rows(batch, staying, unique, id_column, rules, foreign_keys), "replacements")
    replaced = existing.join(batch.select(id_column), id_column, "left_semi")
    candidates = judged.where(F.col(REASON).isNull())
    wanted = reduce(DataFrame.unionAll, [
        lookup(
            candidates.dropna(subset=list(keys)).select(F.col(id_column).alias("row"), *keys),
            replaced.dropna(subset=list(keys)).select(*keys, F.col(id_column).alias("to")), keys, "inner",
        ).select("row", "to", F.lit(k).alias("k"))
        for k, keys in enumerate(unique)
    ]).where(F.col("row") != F.col("to"))
    wanted = stage(wanted, "wanted")
    refused = judged.where(F.col(REASON).isNotNull()).select(F.col(id_column).alias("row"))
    reached = stage(_reached(wanted.select("row", "to").distinct(), refused), "refused")
    gone = refused.unionAll(reached).select(F.col("row").alias("to"))
    first = wanted.join(gone, "to", "left_semi").groupBy("row").agg(F.min("k").alias("k"))
    label = F.element_at(F.array(*[F.lit(_label(keys)) for keys in unique]), F.col("k") + 1)
    why = first.join(reached, "row", "left_semi").select(F.col("row").alias(id_column), label.alias("_why"))
    return judged.join(why, id_column, "left").withColumn(REASON, F.coalesce(REASON, "_why")).drop("_why")


def split(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows without the reason, rejected rows with it)."""
    return judged.where(F.col(REASON).isNull()).drop(REASON), judged.where(F.col(REASON).isNotNull())


def replace_rows(
    table: DataFrame, batch: DataFrame, id_column: str, refresh: Mapping[str, Column] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(table after full replacement by id, batch rows whose id does not exist).

    ``batch`` holds each id once. ``refresh`` sets columns such as ``loaded_at``.
    """
    ids = table.select(id_column)
    known = batch.join(ids, id_column, "left_semi")
    missing = batch.join(ids, id_column, "left_anti")
    return upsert(table, known, [id_column], on_update=refresh).drop(CHANGE), missing

"""Ranks within groups and the rows at the top."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from goldspine.sinks.staging import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TASK, _PLACE, _LOCAL, _FIRST = "_rank_task", "_rank_place", "_rank_local", "_rank_first"


def _changed(column: pa.Array) -> np.ndarray:
    """Where a value differs from the one before it: two nulls are equal, and two NaN."""
    one, other = column.slice(0, len(column) - 1), column.slice(1)
    same = pc.or_(pc.fill_null(pc.equal(one, other), False), pc.and_(pc.is_null(one), pc.is_null(other)))
    if pa.types.is_floating(column.type):
        same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(one), pc.is_nan(other)), False))
    return ~same.to_numpy(zero_copy_only=False)


def _numbered(group: str, measure: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows with their place in the task, the number of their value among those of the group, and whether the group is the first."""
        last, held, place, groups = None, 0, 0, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = [batch.column(group), batch.column(measure)]
            if last is None:
                new_group, new_value = (np.concatenate([[True], _changed(c)]) for c in keys)
            else:
                new_group, new_value = (_changed(pa.concat_arrays([p, c])) for p, c in zip(last, keys))
            new_value = new_value | new_group
            # Values so far, less those before the row's group.
            values = held + np.cumsum(new_value)
            before = np.maximum.accumulate(np.where(new_group, values - 1, 0))
            nth_group = groups + np.cumsum(new_group)
            columns = [place + np.arange(n), values - before, nth_group == 1]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, columns)], names=[*batch.schema.names, _PLACE, _LOCAL, _FIRST])
            last, held = [c.slice(n - 1) for c in keys], int(values[-1] - before[-1])
            place, groups = place + n, int(nth_group[-1])

    return run


def dense_rank_within(df: DataFrame, group: str, measure: str, rank: str) -> DataFrame:
    """Add ``rank``: 1 for the highest ``measure`` of the row's group, no gaps; a null measure is the highest.

    Rows are dealt to tasks by ranges of (group, measure), once, and equal ones
    by chance, so neither a group nor a value meets in one task. A task numbers
    the values of each of its groups. Its first group may have begun in earlier
    tasks; then what these hold of it is added, less one for a value that goes on.
    For that a row comes from each task.
    """
    highest = F.col(measure).desc_nulls_first()
    dealt = df.withColumn("_rank_chance", F.rand(1)).repartitionByRange(F.col(group), highest, "_rank_chance").drop("_rank_chance")
    sorted_rows = dealt.sortWithinPartitions(F.col(group), highest).withColumn(_TASK, F.spark_partition_id())
    layout = T.StructType([*sorted_rows.schema, T.StructField(_PLACE, T.LongType()), T.StructField(_LOCAL, T.LongType()), T.StructField(_FIRST, T.BooleanType())])
    placed = stage(sorted_rows.mapInArrow(_numbered(group, measure), layout), "ranks")
    ends = placed.select(_TASK, _PLACE, _LOCAL, F.struct(F.col(group).alias("g"), F.col(measure).alias("m")).alias("_v")).groupBy(_TASK).agg(
        F.min_by("_v", _PLACE).alias("first"), F.max_by("_v", _PLACE).alias("last"), F.max_by(_LOCAL, _PLACE).alias("n")
    )
    in_order = Window.orderBy(_TASK)
    before = F.lag("last").over(in_order)
    borders = ends.select(
        _TASK, "n", F.col("first.g").eqNullSafe(F.col("last.g")).alias("one_group"),
        (F.col("n").isNotNull() & before.isNotNull() & F.col("first.g").eqNullSafe(before["g"])).alias("goes_on"),
        F.col("first.m").eqNullSafe(before["m"]).alias("same_value"),
    ).orderBy(_TASK).collect()
    offsets, held = [], 0
    for task in borders:
        offset = held - int(task.same_value) if task.goes_on else 0
        if offset:
            offsets.append((task[_TASK], offset))
        held = task.n + (offset if task.one_group else 0)
    number = F.col(_LOCAL)
    if offsets:
        more = df.sparkSession.createDataFrame(offsets, f"{_TASK} int, _rank_more long")
        # A row for each task that goes on with a group.
        placed = placed.join(F.broadcast(more), _TASK, "left")
        number = number + F.when(F.col(_FIRST), F.coalesce("_rank_more", F.lit(0))).otherwise(0)
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], number.cast("bigint").alias(rank))


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The ``k`` first rows under ``order``, which should end in a unique key."""
    if k < 1:
        raise ValueError("k must be at least 1")
    return df.orderBy(*order).limit(k)


def top_k_by_measure(df: DataFrame, measure: str, tie_break: Sequence[str], k: int) -> DataFrame:
    """The ``k`` rows with the highest numeric ``measure``, ties by ``tie_break``.

    A first pass over the measure alone counts rows per magnitude class (at
    most a few hundred thousand classes for any doubles) and finds the class
    that holds the k-th row. Only rows from that class upwards are sorted, so
    the last merge sees little more than ``k`` rows however many files are read.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    rows = df.where(F.col(measure).isNotNull())
    counts = rows.groupBy(_magnitude(F.col(measure)).alias("c")).agg(F.count("*").alias("n"))
    above = Window.orderBy(F.col("c").desc()).rowsBetween(Window.unboundedPreceding, -1)
    needed = counts.withColumn("before", F.coalesce(F.sum("n").over(above), F.lit(0))).where(F.col("before") < k)
    floor = needed.agg(F.min("c").alias("c")).first()[0]
    if floor is not None:
        rows = rows.where(_magnitude(F.col(measure)) >= F.lit(floor))
    order = [F.col(measure).desc(), *[F.col(name).asc() for name in tie_break]]
    return top_k(rows, order, k)


def _magnitude(value: Column) -> Column:
    """A class number that never falls as the value rises: sign and log2 in 1/64 steps.

    Infinities and NaN share the outermost classes.
    """
    size = F.least(F.abs(value.cast("double")), F.lit(1e300)) + F.lit(1e-300)
    step = F.floor(F.log2(size) * 64).cast("int") + F.lit(1 << 17)
    return F.when(value > 0, step).when(value < 0, -step).otherwise(F.lit(0))

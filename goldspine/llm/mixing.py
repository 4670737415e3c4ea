"""Mixing sources to target weights.

Targets are shares of a word budget, filled by weight up to a cap of each
source's size. A source takes whole documents: all of them once if its target
reaches its size, and then blocks of documents in a permuted order until the
target is met; past the cut each document of the later blocks that still fits. A splitting tree hands each output shard its exact number of
blocks of every source: a node's blocks are halved, each source's part of the
left half follows the multivariate hypergeometric law, given by its block
counts. Shards then draw disjoint runs of the permuted blocks and order their
documents by hash. Every draw is a hash of names and numbers, so reruns agree.

All of it is DataFrame operations. What meets in one task is one row for each
source (targets), one row for each block (the cut, and each round past it), and
one block's documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from goldspine.llm.keys import FP, ID, TEXT, keyed, public_id
from goldspine.sinks.staging import stage

_BLANK = " \t\n\x0b\x0c\r"
_SIGMAS = 8
#: A source's blocks meet in one task; beyond these, blocks hold more documents.
_MOST_BLOCKS = 1 << 16


def same_source(left: str, right: str, *keys: str) -> Column:
    """Equal sources, null being one, and equal keys."""
    on = F.col(f"{left}._source").eqNullSafe(F.col(f"{right}._source"))
    for key in keys:
        on = on & (F.col(f"{left}.{key}") == F.col(f"{right}.{key}"))
    return on


def _words() -> Column:
    """How many runs of anything but blanks."""
    trimmed = F.btrim(TEXT, F.lit(_BLANK))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, "[\\x20\\x09-\\x0D]+", -1))).cast("long")


def _uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) fixed by the parts."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / float(1 << 52)


def targets(sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), budget: float = 1.5, cap: float = 2.0) -> DataFrame:
    """A source's target, from ``_source`` and ``source_size``.

    Weights repeat over the sources by code point, null last. What a source
    cannot take above ``cap`` times its size is shared anew by weight, until no
    target is above. That ends at one level: the sources with the least
    size per weight are capped, all others get the same multiple of their weight.
    """
    if cap < budget:
        raise ValueError("the cap must allow the budget")
    by_name = W.orderBy(F.col("_source").asc_nulls_last())
    cases = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = sizes.withColumn("_weight", cases).withColumn("_most", cap * F.col("source_size"))
    # In the order of size per weight: what the sources before take if capped, and the weight of the rest.
    fills = W.orderBy((F.col("_most") / F.col("_weight")).asc(), F.col("_source").asc_nulls_last())
    before, whole = fills.rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    level = (budget * F.sum("source_size").over(whole) - F.coalesce(F.sum("_most").over(before), F.lit(0.0))) / (
        F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    )
    levelled = weighed.withColumn("_level", level)
    # The first source that its level does not fill sets it for all that follow; later ones come out lower.
    open_level = F.max(F.when(F.col("_level") * F.col("_weight") <= F.col("_most"), F.col("_level"))).over(whole)
    return levelled.withColumn(
        "target", F.coalesce(F.least(F.col("_most"), open_level * F.col("_weight")), F.col("_most"))
    ).drop("_most", "_level")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _hypergeometric(blocks: Column, mine: Column, drawn: Column, u: Column) -> Column:
    """How many of ``mine`` among ``blocks`` fall into ``drawn`` draws: inverse of the distribution at ``u``.

    The probabilities run over the mean and eight deviations either way, within
    what is possible, by the ratio of neighbouring ones from the mode.
    """
    none = F.array().cast("array<bigint>")

    def ratio(v: Column, x: Column) -> Column:  # of the probability of x + 1 to that of x
        return (v["k"] - x) * (v["d"] - x) / ((x + 1) * (v["n"] - v["k"] - v["d"] + x + 1))

    def bounds(v: Column) -> Column:
        n, k, d = v["n"], v["k"], v["d"]
        share = k / F.greatest(n, F.lit(1.0))
        deviation = F.sqrt(F.greatest(F.lit(0.0), d * share * (1 - share) * (n - d) / F.greatest(n - 1, F.lit(1.0))))
        return F.struct(
            n.alias("n"), k.alias("k"), d.alias("d"), v["u"].alias("u"),
            F.greatest(F.lit(0.0), d + k - n).alias("low"), F.least(k, d).alias("high"),
            F.floor((d + 1) * (k + 1) / (n + 2)).cast("double").alias("peak"), (F.ceil(_SIGMAS * deviation) + 1).cast("double").alias("reach"),
        )

    def ways(v: Column) -> Column:
        mode = F.greatest(v["low"], F.least(v["high"], v["peak"]))
        first, last = F.greatest(v["low"], mode - v["reach"]), F.least(v["high"], mode + v["reach"])
        return F.struct(
            *[v[c].alias(c) for c in ("n", "k", "d", "u")], mode.alias("mode"),
            F.when(last > mode, F.sequence(mode.cast("long"), last.cast("long") - 1)).otherwise(none).alias("up"),
            F.when(mode > first, F.sequence(mode.cast("long") - 1, first.cast("long"), F.lit(-1).cast("long"))).otherwise(none).alias("down"),
        )

    def masses(v: Column) -> Column:
        start = F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("sum"))
        add = lambda a, p: _let(p, lambda q: F.struct(q.alias("p"), (a["sum"] + q).alias("sum")))
        above = F.aggregate(v["up"], start, lambda a, x: add(a, a["p"] * ratio(v, x.cast("double"))), lambda a: a["sum"])
        below = F.aggregate(v["down"], start, lambda a, x: add(a, a["p"] / ratio(v, x.cast("double"))), lambda a: a["sum"])
        return F.struct(
            *[v[c].alias(c) for c in ("n", "k", "d", "mode", "up", "down")], (v["u"] * (1.0 + above + below)).alias("aim")
        )

    def walk(v: Column) -> Column:
        # Outwards from the mode: mode, then all above, then all below, until the aim is passed.
        def step(a: Column, p: Column, here: Column) -> Column:
            return F.when(a["sum"] > v["aim"], a).otherwise(
                _let(p, lambda q: F.struct(q.alias("p"), (a["sum"] + q).alias("sum"), here.alias("x")))
            )

        start = F.struct(F.lit(1.0).alias("p"), F.lit(1.0).alias("sum"), v["mode"].alias("x"))
        above = F.aggregate(v["up"], start, lambda a, x: step(a, a["p"] * ratio(v, x.cast("double")), x.cast("double") + 1))
        return _let(above, lambda w: F.aggregate(
            v["down"], F.struct(F.lit(1.0).alias("p"), w["sum"].alias("sum"), w["x"].alias("x")),
            lambda a, x: step(a, a["p"] / ratio(v, x.cast("double")), x.cast("double")), lambda a: a["x"].cast("long"),
        ))

    given = F.struct(blocks.cast("double").alias("n"), mine.cast("double").alias("k"), drawn.cast("double").alias("d"), u.alias("u"))
    return _let(given, lambda v: _let(bounds(v), lambda w: _let(ways(w), lambda x: _let(masses(x), walk))))


def split(quotas: DataFrame, depth: int, seed: int = 0) -> DataFrame:
    """``_source, _shard, _first, _blocks``: which of a source's permuted blocks each of 2**depth shards gets.

    ``quotas`` has a source's number of blocks. A node of the tree is one row
    with its sources' counts; the left child takes half of its blocks, source by
    source, each draw given those before.
    """
    root = quotas.agg(F.array_sort(F.collect_list(F.struct(F.hash("_source").alias("h"), F.col("_source").alias("s"), F.col("_blocks").cast("long").alias("n")))).alias("_q"))
    nodes = root.select(F.lit(0).alias("_shard"), "_q")
    zero = F.lit(0).cast("long")
    for level in range(depth):
        def total(q: Column) -> Column:
            return F.aggregate(q, zero, lambda a, x: a + x["n"])

        half = F.floor(total(F.col("_q")) / 2).cast("long")
        start = F.struct(total(F.col("_q")).alias("n"), half.alias("d"), F.array().cast("array<bigint>").alias("out"))

        node = F.lit(f"{seed} {level}")

        def draw(a: Column, x: Column) -> Column:
            u = _uniform(node, F.col("_shard"), x["h"], x["s"])  # noqa: B023
            return _let(_hypergeometric(a["n"], x["n"], a["d"], u), lambda got: F.struct(
                (a["n"] - x["n"]).alias("n"), (a["d"] - got).alias("d"), F.concat(a["out"], F.array(got)).alias("out")
            ))

        drawn = stage(nodes.select("_shard", "_q", F.aggregate("_q", start, draw, lambda a: a["out"]).alias("_left")), "mix-tree")
        part = lambda n: F.transform("_q", lambda x, i: F.struct(x["h"].alias("h"), x["s"].alias("s"), n(x, i).alias("n")))
        left = part(lambda x, i: F.get("_left", i))
        right = part(lambda x, i: x["n"] - F.get("_left", i))
        nodes = drawn.select(F.explode(F.array(
            F.struct((2 * F.col("_shard")).alias("_shard"), left.alias("_q")),
            F.struct((2 * F.col("_shard") + 1).alias("_shard"), right.alias("_q")),
        )).alias("_n")).select("_n.*")
    leaves = nodes.select("_shard", F.explode("_q").alias("_x")).select(F.col("_x.s").alias("_source"), "_shard", F.col("_x.n").alias("_blocks"))
    before = W.partitionBy("_source").orderBy("_shard").rowsBetween(W.unboundedPreceding, -1)
    return leaves.withColumn("_first", F.coalesce(F.sum("_blocks").over(before), zero))


def _fill(pool: DataFrame, state: DataFrame) -> DataFrame:
    """``_source, _block, _o, _cut`` of the documents that a source takes: in order, each that fits what is left of ``_gap``.

    Documents larger than the gap never fit. Of the others all are taken up to
    the first that does not fit; from there on the same holds of the new gap,
    which is smaller than that document. A round does this for all sources by
    a running sum over blocks, and over the documents of a block.
    """
    of_source = W.partitionBy("_source").orderBy("_rank").rowsBetween(W.unboundedPreceding, -1)
    of_block = W.partitionBy("_source", "_rank").orderBy("_o").rowsBetween(W.unboundedPreceding, 0)
    state = state.select("_source", "_gap", F.lit(None).cast("struct<r:bigint,o:bigint>").alias("_from"))
    chosen = None
    while True:
        state = stage(state, "mix-gaps")
        if chosen is not None and state.isEmpty():
            return chosen
        place = F.struct(F.col("_rank").alias("r"), F.col("_o").alias("o"))
        fitting = pool.alias("p").join(state.alias("s"), same_source("p", "s")).where(
            (F.col("size") <= F.col("_gap")) & (F.col("_from").isNull() | (place > F.col("_from")))
        ).select("p._source", "_block", "_rank", "_cut", "_o", "size", "_gap")
        blocks = fitting.groupBy("_source", "_rank").agg(F.sum("size").alias("_all"))
        reached = blocks.select("_source", "_rank", F.coalesce(F.sum("_all").over(of_source), F.lit(0)).alias("_before"))
        met = fitting.alias("f").join(reached.alias("r"), same_source("f", "r", "_rank")).where(F.col("_before") <= F.col("_gap")).select(
            "f._source", "_block", "f._rank", "_cut", "_o", "size", "_gap", "_before"
        )
        summed = stage(met.withColumn("_run", F.col("_before") + F.sum("size").over(of_block)), "mix-fill")
        taken = summed.where("_run <= _gap").select("_source", "_block", "_o", "_cut")
        chosen = taken if chosen is None else chosen.unionByName(taken)
        state = summed.groupBy("_source").agg(
            (F.first("_gap") - F.coalesce(F.max(F.when(F.col("_run") <= F.col("_gap"), F.col("_run"))), F.lit(0))).alias("_gap"),
            F.min(F.when(F.col("_run") > F.col("_gap"), place)).alias("_from"),
        ).where(F.col("_from").isNotNull())


def mix(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
    weights: Sequence[float] = (3, 1, 2), budget: float = 1.5, cap: float = 2.0,
    block_docs: int = 32, depth: int = 4, seed: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """The sources' documents with their targets, and the mix: a row for each copy of a document taken.

    Documents: ``_id, _fp, size, _source, source_size, target``. Mix: ``_id,
    _fp, _source, _copy, _shard, _order``; a shard is to be written in ``_order``.
    Null texts have size 0 and null sources are a source of their own. A source
    without words has target 0 and takes nothing. Rows that are equal in id,
    text and source are taken alike; those of two sources are two documents.
    An empty table mixes to an empty one.
    """
    source = F.col(f"`{source_column}`").cast("string").alias("_source")
    rows = stage(keyed(docs, id_column, text_column, source).select(ID, FP, "_source", _words().alias("size")), "mix-sizes")
    per_source = rows.groupBy("_source").agg(F.sum("size").alias("source_size"), F.count("size").alias("_docs"))
    aims = stage(
        targets(per_source, weights, budget, cap)
        .withColumn("_whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("_more", F.col("target") - F.col("_whole") * F.col("source_size"))
        .withColumn("_parts", F.least(F.lit(_MOST_BLOCKS), F.ceil(F.col("_docs") / block_docs)).cast("long")),
        "mix-targets",
    )
    blocked = rows.alias("r").join(aims.alias("a"), same_source("r", "a")).select(
        ID, FP, "size", "r._source", "source_size", "target", "_whole", "_more",
        F.pmod(F.xxhash64(F.lit(seed), ID, FP), F.col("_parts")).alias("_block"),
    )
    # Blocks in permuted order, and where the part of the target beyond whole passes ends.
    block_sizes = blocked.groupBy("_source", "_block").agg(F.sum("size").alias("_size"), F.first("_more").alias("_more"), F.first("_whole").alias("_whole"))
    permuted = W.partitionBy("_source").orderBy(F.xxhash64(F.lit(seed), F.lit("block"), "_source", "_block"), "_block")
    ranked = block_sizes.select(
        "*", (F.row_number().over(permuted) - 1).cast("long").alias("_rank"),
        F.coalesce(F.sum("_size").over(permuted.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
    ).withColumn("_left", F.col("_more") - F.col("_before"))
    cut = stage(ranked.select("_source", "_block", "_size", "_rank", "_whole", "_left"), "mix-blocks")
    partial = (F.col("_left") > 0) & (F.col("_left") < F.col("_size"))
    # From the block that holds the cut on: each document that still fits. Those of
    # later blocks go with the block of the cut.
    boundary = cut.where(partial).select("_source", F.col("_rank").alias("_cut"), F.col("_left").alias("_gap"))
    beyond = cut.alias("d").join(boundary.alias("c"), same_source("d", "c")).where(F.col("_rank") >= F.col("_cut")).select(
        "d._source", "_block", "_rank", "_cut", "_gap"
    )
    pool = blocked.alias("b").join(beyond.alias("c"), same_source("b", "c", "_block")).where(
        (F.col("size") <= F.col("_gap")) & ((F.col("size") > 0) | (F.col("_rank") == F.col("_cut")))
    ).groupBy("b._source", "b._block", "_rank", "_cut", F.xxhash64(F.lit(seed), F.lit("doc"), ID, FP).alias("_o")).agg(F.sum("b.size").alias("size"))
    chosen = _fill(stage(pool, "mix-pool"), boundary)
    passes = F.col("_whole") + F.when((F.col("_left") >= F.col("_size")) & (F.col("_left") > 0), 1).otherwise(0)
    everywhere = cut.select("_source", "_block", "_rank", passes.alias("_passes"))
    placed = blocked.alias("b").join(everywhere.alias("e"), same_source("b", "e", "_block")).select(
        ID, FP, "size", "b._source", "b._block", "source_size", "target", "_rank", "_passes",
        F.xxhash64(F.lit(seed), F.lit("doc"), ID, FP).alias("_o"),
    )
    p = placed.alias("p").join(
        chosen.alias("c"), same_source("p", "c", "_block", "_o"), "left"
    )
    counted = stage(p.select(
        ID, FP, "size", "p._source", "p._block", "source_size", "target", "_rank", "p._o",
        (F.col("_passes") + F.when(F.col("c._o").isNotNull(), 1).otherwise(0)).alias("copies"),
        # Where the last copy is placed.
        F.coalesce("c._cut", "_rank").alias("_last"),
    ), "mix-documents")
    # A source's blocks are (pass, block); the block of the cut is one of them.
    spans = cut.select("_source", "_block", "_rank", (passes + F.when(partial, 1).otherwise(0)).alias("_n"))
    quotas = spans.groupBy("_source").agg(F.sum("_n").alias("_blocks"), F.count("_n").alias("_parts"))
    shards = split(quotas.select("_source", "_blocks"), depth, seed)
    ranges = shards.groupBy("_source").agg(F.array_sort(F.collect_list(F.struct((F.col("_first") + F.col("_blocks")).alias("e"), F.col("_shard").alias("s")))).alias("_ends"))
    q = quotas.alias("q").join(ranges.alias("g"), same_source("q", "g")).select("q._source", "_parts", "_ends")
    copies = counted.where(F.col("copies") > 0).select(
        ID, FP, "_source", "_o", "copies", "_rank", "_last", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("_copy")
    )
    c = copies.alias("c").join(q.alias("q"), same_source("c", "q"))
    # Pass 0 of the blocks in permuted order, then pass 1; a place beyond the last end cannot be.
    place = F.col("_copy") * F.col("_parts") + F.when(F.col("_copy") == F.col("copies") - 1, F.col("_last")).otherwise(F.col("_rank"))
    shard = F.get(F.filter("_ends", lambda x: x["e"] > place), F.lit(0))["s"]
    mixed = c.select(ID, FP, "c._source", "_copy", shard.alias("_shard"), F.xxhash64(F.lit(seed), F.lit("order"), ID, FP, "_copy").alias("_order"))
    return counted, mixed


def summary(docs: DataFrame) -> DataFrame:
    documents, mixed = mix(docs)
    taken = mixed.groupBy(ID, FP, "_source", "_copy").agg(F.min("_shard").alias("_shard")).groupBy(ID, FP, "_source").agg(
        F.count("_copy").alias("_n"), F.array_join(F.transform(F.array_sort(F.collect_list("_shard")), lambda s: s.cast("string")), ",").alias("shards")
    )
    found = documents.alias("d").join(taken.alias("t"), same_source("d", "t", ID, FP), "left").select("d.*", "_n", "shards")
    return found.select(
        public_id("doc_id"), "size", "source_size", "target",
        (F.col("size") * F.coalesce("_n", F.lit(0))).alias("taken"), F.coalesce("shards", F.lit("")).alias("shards"),
    )

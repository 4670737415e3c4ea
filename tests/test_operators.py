import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from goldspine.operators import access, quality as Q
from goldspine.operators.aggregates import duplicate_count, group_counts, key_summary, rows_per_source
from goldspine.operators.components import components
from goldspine.operators.crud import judge_replacements, ForeignKey, create_rows, replace_rows, split
from goldspine.operators.dedupe import (
    DuplicateKeys, assert_unique, duplicate_keys, first_per_key, highest_per_key, keep_last, latest_per_key,
)
from goldspine.operators.joins import lookup, orphans
from goldspine.operators.ranking import dense_rank_within, top_k, top_k_by_measure
from goldspine.operators.referential import cascade_delete, cascade_key, delete_rows, set_null
from goldspine.operators.upsert import CHANGE, assign_ids, upsert
from goldspine.sinks.staging import stage


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def skewed(spark, rows=6000, seed=3):
    """A third of the rows share key 0, another part has no key."""
    draw = random.Random(seed)
    data = [
        (i, 0 if i % 3 == 0 else (None if i % 17 == 0 else draw.randrange(1, 500)), draw.randrange(0, 40), draw.random())
        for i in range(rows)
    ]
    return data, spark.createDataFrame(data, "id int, k int, t int, v double").repartition(6)


def test_keep_last_and_latest_on_a_hot_key(spark):
    data, df = skewed(spark)
    last = {}
    for row in data:
        last[row[1]] = row
    assert {r.k: tuple(r) for r in keep_last(df, ["k"], ["id"]).collect()} == last
    best = {}
    for row in data:
        if row[1] not in best or (row[2], row[0]) > (best[row[1]][2], best[row[1]][0]):
            best[row[1]] = row
    assert {r.k: tuple(r) for r in latest_per_key(df, ["k"], "t", ("id",)).collect()} == best


def test_only_one_row_per_key_leaves_a_task(spark):
    data, df = skewed(spark)
    staged = stage(df, "t")
    assert "partial_max" in plan(keep_last(staged, ["k"], ["id"]))
    by_window = first_per_key(staged, ["k"], [F.col("id").asc()])
    assert "WindowGroupLimit" in plan(by_window)
    first = {}
    for row in data:
        first.setdefault(row[1], row)
    assert {r.k: tuple(r) for r in by_window.collect()} == first


def test_highest_per_key_carries_unorderable_columns(spark):
    df = spark.createDataFrame([("a", 1, {"x": 1}), ("a", 2, {"x": 2}), (None, 5, None)], "k string, n int, m map<string,int>")
    assert {r.k: (r.n, r.m) for r in highest_per_key(df, ["k"], ["n"]).collect()} == {"a": (2, {"x": 2}), None: (5, None)}
    tied = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y")], "k string, n int, v string")
    assert highest_per_key(tied, ["k"], ["n"]).first().v == "y"


def test_null_period_never_wins(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 3, 2), ("b", None, 3)], "k string, t int, v int")
    assert {r.k: r.v for r in latest_per_key(df, ["k"], "t").collect()} == {"a": 2, "b": 3}


def test_uniqueness(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k int")
    assert {r.k: r.rows for r in duplicate_keys(df, ["k"]).collect()} == {1: 2, None: 2}
    with pytest.raises(DuplicateKeys):
        assert_unique(df, ["k"], "test")
    assert_unique(df.distinct().unionAll(spark.createDataFrame([(None,)], "k int")), ["k"], "nulls may repeat")
    assert df.agg(duplicate_count("k")).first()[0] == 2
    assert tuple(key_summary(df, ["k"]).first()) == (5, 2)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_equals_a_plain_join(spark, how):
    data, df = skewed(spark, 900)
    dup = df.unionAll(df.limit(5))
    one = spark.createDataFrame([(k, f"n{k}") for k in range(0, 300)], "k int, name string")
    expected = sorted(map(str, dup.join(one, "k", how).collect()))
    assert sorted(map(str, lookup(dup, one, ["k"], how).collect())) == expected


def test_lookup_rejects_other_joins(spark):
    df = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(ValueError):
        lookup(df, df, ["k"], "full")


def test_orphans(spark):
    data, df = skewed(spark, 600)
    parents = spark.createDataFrame([(k,) for k in range(1, 500, 2)] * 2, "p int")
    expected = {r[0] for r in data if r[1] is not None and r[1] % 2 == 0}
    assert {r.id for r in orphans(df, parents, "k", "p").collect()} == expected


def test_dense_rank_equals_brute_force(spark):
    draw = random.Random(5)
    data = [(i, draw.choice("aaab") if i % 11 else None, draw.choice([None, *range(60)])) for i in range(2500)]
    df = spark.createDataFrame(data, "id int, g string, m int").repartition(5)
    values = defaultdict(set)
    for _, g, m in data:
        values[g].add(m)
    order = {g: sorted(v, key=lambda m: (m is not None, -(m or 0))) for g, v in values.items()}
    found = {r.id: r.rank for r in dense_rank_within(df, "g", "m", "rank").collect()}
    assert found == {i: order[g].index(m) + 1 for i, g, m in data}


def test_rank_over_many_tasks(spark):
    df = stage(spark.range(4000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 1999).alias("m")), "r")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = dense_rank_within(df, "g", "m", "rank").distinct().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    from pyspark.sql import Window

    plain = df.withColumn("rank", F.dense_rank().over(Window.partitionBy("g").orderBy(F.desc("m"))).cast("bigint"))
    assert set(found) == set(plain.distinct().collect())


def test_one_value_of_half_the_rows_is_ranked_in_many_tasks(spark):
    """The rows of one (group, measure) are in several tasks; the frame is shuffled once."""
    df = spark.range(6000).select("id", F.lit("g").alias("g"), F.when(F.col("id") % 2 == 0, 7.0).otherwise(F.col("id") % 11).cast("double").alias("m"))
    df = stage(df.withColumn("m", F.when(F.col("id") % 10 == 1, F.lit(float("nan"))).otherwise(F.col("m"))), "r")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = dense_rank_within(df, "g", "m", "rank")
        assert "Exchange hashpartitioning" not in plan(ranked) and "Exchange rangepartitioning" not in plan(ranked)
        found = ranked.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    from pyspark.sql import Window

    plain = {r.id: r.rank for r in df.withColumn("rank", F.dense_rank().over(Window.partitionBy("g").orderBy(F.desc("m")))).collect()}
    assert {r.id: r.rank for r in found} == plain


def test_top_k_by_measure(spark):
    draw = random.Random(9)
    values = [draw.choice([-1, 1]) * 10 ** draw.uniform(-8, 8) for _ in range(3000)]
    values += [0.0, -0.0, float("inf"), float("-inf"), 5.0, 5.0, 5.0]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v double").repartition(7)
    full = sorted(enumerate(values), key=lambda r: (-r[1], r[0]))
    for k in (1, 3, 700, 1500, 2999, 5000):
        assert [tuple(r) for r in top_k_by_measure(df, "v", ("id",), k).collect()] == [r for r in full][:k]
    with pytest.raises(ValueError):
        top_k(df, [F.col("v")], 0)
    with pytest.raises(ValueError):
        top_k_by_measure(df, "v", ("id",), 0)
    assert top_k_by_measure(df.limit(0), "v", ("id",), 3).count() == 0
    whole = spark.createDataFrame([(1, 2**62), (2, 2**62 + 1), (3, None)], "id int, v bigint")
    assert [r.id for r in top_k_by_measure(whole, "v", ("id",), 1).collect()] == [2]


def test_group_counts(spark):
    df = spark.createDataFrame([("a", True), ("a", True), ("b", True), ("b", False), (None, True)], "g string, on boolean")
    assert [tuple(r) for r in group_counts(df, "g", 1, F.col("on")).collect()] == [("a", 2), ("b", 1)]
    assert [tuple(r) for r in group_counts(df, "g", 2, F.col("on")).collect()] == [("a", 2)]


def test_rows_per_source(spark):
    frames = {"x": spark.range(3), "y": spark.range(5)}
    assert {r.source: r.rows for r in rows_per_source(frames).collect()} == {"x": 3, "y": 5}


def test_upsert(spark):
    target = spark.createDataFrame([(10, "a", 1, "old", False), (11, "b", 2, "old", False)], "id int, k string, v int, keep string, active boolean")
    incoming = spark.createDataFrame([("b", 20, 99), ("c", 30, 98)], "k string, v int, _id int")
    out = upsert(target, incoming, ["k"], ["v", "_id"], on_update={"active": F.lit(True)}, on_insert={"id": F.col("_new._id")})
    assert {tuple(r) for r in out.select("id", "k", "v", "keep", "active", CHANGE).collect()} == {
        (10, "a", 1, "old", False, "kept"), (11, "b", 20, "old", True, "updated"), (98, "c", 30, None, None, "inserted"),
    }
    again = upsert(target, incoming.select("k", "v"), ["k"]).drop(CHANGE)
    assert sorted(map(str, upsert(again, incoming.select("k", "v"), ["k"]).drop(CHANGE).collect())) == sorted(map(str, again.collect()))


def test_upsert_null_incoming_value_replaces(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    incoming = spark.createDataFrame([("a", None)], "k string, v int")
    assert upsert(target, incoming, ["k"]).first().v is None


def test_assigned_ids_are_dense_and_unique(spark):
    rows = spark.range(1000).select(F.concat(F.lit("n"), "id").alias("name")).repartition(7)
    numbered = assign_ids(rows, "id", 41)
    first = {r.name: r.id for r in numbered.collect()}
    assert sorted(first.values()) == list(range(42, 1042))
    assert {r.name: r.id for r in numbered.collect()} == first
    assert assign_ids(rows.limit(0), "id", 5).count() == 0


def test_referential_actions(spark):
    parents = spark.createDataFrame([(i,) for i in range(10)], "p int")
    children = spark.createDataFrame([(i, i % 4 if i % 5 else None) for i in range(200)], "c int, p int")
    ids = spark.createDataFrame([(1,), (1,), (7,), (99,), (None,)], "p int")
    out = delete_rows(parents, ids, "p", children, "p")
    assert {r.p for r in out.deleted.collect()} == {7}
    assert {r.p for r in out.blocked.collect()} == {1}
    assert {r.p for r in out.missing.collect()} == {99}
    assert {r.p for r in out.remaining.collect()} == set(range(10)) - {7}
    free = delete_rows(parents, ids, "p")
    assert {r.p for r in free.deleted.collect()} == {1, 7} and free.blocked.count() == 0
    nulled = {r.c: r.p for r in set_null(children, ids, "p", "p").collect()}
    assert nulled == {i: (None if i % 5 == 0 or i % 4 == 1 else i % 4) for i in range(200)}
    left = {r.c for r in cascade_delete(children, ids, "p", "p").collect()}
    assert left == {i for i in range(200) if i % 5 == 0 or i % 4 != 1}
    moves = spark.createDataFrame([(1, 100), (2, None)], "old_key int, new_key int")
    moved = {r.c: r.p for r in cascade_key(children, moves, "p").collect()}
    assert moved == {i: None if i % 5 == 0 else {1: 100, 2: None}.get(i % 4, i % 4) for i in range(200)}


def sequential(batch, stored, unique):
    """What creating the rows one after another would do."""
    taken = [{tuple(row[k] for k in keys) for row in stored} for keys in unique]
    accepted = []
    for row in sorted(batch, key=lambda r: r["n"]):
        keys = [tuple(row[k] for k in key) for key in unique]
        if any(None not in key and key in seen for key, seen in zip(keys, taken)):
            continue
        accepted.append(row["n"])
        for key, seen in zip(keys, taken):
            seen.add(key)
    return accepted


@pytest.mark.parametrize("unique", [[["a"]], [["a"], ["b"]], [["a", "b"], ["c"]], [["a"], ["b"], ["c"]]])
def test_batch_create_equals_one_after_another(spark, unique):
    draw = random.Random(len(unique) * 7 + len(unique[0]))
    batch = [{"n": n, **{c: draw.choice([None, *range(12)]) for c in "abc"}} for n in range(80)]
    stored = [{c: 100 if i else draw.randrange(12) for c in "abc"} for i in range(2)]
    ddl = "a int, b int, c int"
    judged = create_rows(
        spark.createDataFrame([(r["n"], r["a"], r["b"], r["c"]) for r in batch], "n int, " + ddl),
        spark.createDataFrame([(r["a"], r["b"], r["c"]) for r in stored], ddl),
        unique, "n",
    )
    accepted, rejected = split(judged)
    assert sorted(r.n for r in accepted.collect()) == sequential(batch, stored, unique)
    assert rejected.count() == len(batch) - accepted.count()


@pytest.mark.parametrize("most", [10_000, 5])
def test_batch_create_on_long_chains(spark, most, monkeypatch):
    """Rows that block each other one after the other, 300 in a chain, and one key that a third of all rows have."""
    from goldspine.operators import crud

    monkeypatch.setattr(crud._settle_in_order, "__defaults__", (most,))
    batch = [{"n": 1000 * g + k, "a": 1000 * g + k // 2, "b": 1000 * g + (k + 1) // 2} for g in range(2) for k in range(300 if most > 5 else 12)]
    batch += [{"n": 5000 + k, "a": -1, "b": 5000 + k % 50} for k in range(300)]
    random.Random(1).shuffle(batch)
    stored = [{"a": 1003, "b": -9}]
    judged = create_rows(
        spark.createDataFrame([(r["n"], r["a"], r["b"]) for r in batch], "n int, a int, b int").repartition(4),
        spark.createDataFrame([(r["a"], r["b"]) for r in stored], "a int, b int"), [["a"], ["b"]], "n",
    )
    found = {r.n: r.reason for r in judged.collect()}
    assert sorted(n for n, reason in found.items() if reason is None) == sequential(batch, stored, [["a"], ["b"]])
    assert (found[1], found[1006], found[5001], found[2]) == ("conflict on a", "conflict on a", "conflict on a", None)


def replaced_one_after_another(batch, stored, unique):
    """Ids of the replacements that stand, by refusing rows until no stored key is in the way."""
    staying = [r for r in stored if r["id"] not in {b["id"] for b in batch}]
    alive = [b for b in batch if b["id"] in sequential([{**b, "n": b["id"]} for b in batch], staying, unique)]
    while True:
        ids = {b["id"] for b in alive}
        held = [{tuple(r[k] for k in keys) for r in stored if r["id"] not in ids} for keys in unique]
        after = [b for b in alive if not any(tuple(b[k] for k in keys) in h for keys, h in zip(unique, held) if None not in [b[k] for k in keys])]
        if len(after) == len(alive):
            return sorted(ids)
        alive = after


@pytest.mark.parametrize("seed", range(3))
def test_replacements_equal_one_after_another(spark, seed):
    draw = random.Random(seed)
    stored = [{"id": i, "a": i, "b": 100 + i} for i in range(60)]
    batch = [{"id": i, "a": draw.choice([draw.randrange(70), i, None]), "b": draw.choice([100 + draw.randrange(70), 100 + i])} for i in draw.sample(range(60), 45)]
    frame = lambda rows: spark.createDataFrame([(r["id"], r["a"], r["b"]) for r in rows], "id int, a int, b int")
    unique = [["a"], ["b"]]
    judged = judge_replacements(frame(batch), frame(stored), unique, "id")
    accepted, _ = split(judged)
    assert judged.count() == len(batch)
    assert sorted(r.id for r in accepted.collect()) == replaced_one_after_another(batch, stored, unique)


def test_replacements_follow_chains_in_few_rounds(spark, monkeypatch):
    """A thousand rows that each want what the next one holds, behind one that may not change; a ring that may."""
    from goldspine.operators import crud

    staged = []
    monkeypatch.setattr(crud, "stage", lambda df, label, do=crud.stage: staged.append(label) or do(df, label))
    stored = spark.range(1, 2001).select("id", F.col("id").alias("a"), (-F.col("id")).alias("b"))
    to = F.when(F.col("id") % 1000 == 0, F.col("id") - 999).otherwise(F.col("id") + 1)
    batch = stored.select("id", to.alias("a"), F.when(F.col("id") % 2 == 0, -to).otherwise(F.col("b")).alias("b"))
    batch = batch.withColumn("b", F.when(F.col("id") % 2 == 0, F.col("id") + 10_000).otherwise(F.col("b")))
    judged = judge_replacements(batch, stored, [["a"], ["b"]], "id", [Q.Rule("may not change", F.col("id") == 1000)])
    reasons = {r.id: r.reason for r in judged.collect()}
    assert reasons[1000] == "may not change"
    assert {reasons[i] for i in range(1, 1000)} == {"conflict on a"} and {reasons[i] for i in range(1001, 2001)} == {None}
    assert staged.count("pointers") <= 12


def test_pointers_that_multiply(spark):
    """Two pointers for each row, many ways from one to the other: doubling is given up, the result is that of a search."""
    from goldspine.operators.crud import _reached

    draw = random.Random(9)
    to = {i: [draw.randrange(i + 1, min(60, i + 9)) for _ in range(2)] for i in range(59)}
    gone, reached = {50, 17}, set()
    for i in range(58, -1, -1):
        if any(t in gone or t in reached for t in to[i]):
            reached.add(i)
    pointers = spark.createDataFrame(sorted({(i, t) for i, ts in to.items() for t in ts}), "row int, to int")
    found = [r.row for r in _reached(pointers, spark.createDataFrame([(g,) for g in gone], "row int")).collect()]
    assert len(found) == len(set(found)) and set(found) - gone == reached - gone


@pytest.mark.parametrize("piece", [1 << 21, 100])
def test_components(spark, piece, monkeypatch):
    import goldspine.operators.components as module

    monkeypatch.setattr(module, "PIECE_LINKS", piece)
    draw = random.Random(4)
    links = [(draw.randrange(400), draw.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(500)] + [(9, 9)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long").repartition(7)).collect()}
    assert found == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_move_a_fixed_multiple_of_the_links(spark, monkeypatch):
    import goldspine.operators.components as module

    monkeypatch.setattr(module, "PIECE_LINKS", 50)
    written = []

    def counted(df, label, do=module.stage):
        out = do(df, label)
        written.append(out.count())
        return out

    monkeypatch.setattr(module, "stage", counted)
    names = random.Random(3).sample(range(10**9), 4000)
    found = components(spark.createDataFrame(list(zip(names, names[1:])), "a long, b long").repartition(7)).collect()
    assert {r.node: r.component for r in found} == dict.fromkeys(names, min(names))
    assert sum(written) <= 8 * len(names)


@pytest.mark.parametrize("piece, most", [(1 << 18, 10_000), (40, 10_000), (40, 60)])
def test_batch_create_reduces_ranges_first(spark, piece, most, monkeypatch):
    """Chains cut by ranges of ordinals, nulls and a key that lies in all ranges; only keys across ranges are links."""
    from goldspine.operators import crud

    links = []
    monkeypatch.setattr(crud, "components", lambda df, do=crud.components: links.append(df.distinct().count()) or do(df))
    monkeypatch.setattr(crud, "PIECE_ROWS", piece)
    monkeypatch.setattr(crud._settle_in_order, "__defaults__", (most,))
    chain = lambda n: {"n": n, "a": n // 50 * 50 + n % 50 // 2, "b": n // 50 * 50 + (n % 50 + 1) // 2, "c": None}
    batch = [chain(n) for n in range(1000)]
    for n in range(3, 1000, 97):
        batch[n]["c"] = -1
        batch[n]["a"] = None if n % 2 else batch[n]["a"]
    random.Random(2).shuffle(batch)
    judged = create_rows(
        spark.createDataFrame([(r["n"], r["a"], r["b"], r["c"]) for r in batch], "n int, a int, b int, c int").repartition(5),
        spark.createDataFrame([(-1, -1, -9)], "a int, b int, c int"), [["a"], ["b"], ["c"]], "n",
    )
    accepted = sorted(r.n for r in split(judged)[0].collect())
    assert accepted == sequential(batch, [{"a": -1, "b": -1, "c": -9}], [["a"], ["b"], ["c"]])
    assert judged.count() == len(batch) and sum(links) <= 120


def test_a_rejected_row_frees_its_other_keys(spark):
    batch = spark.createDataFrame([(1, "A", "X"), (2, "B", "X"), (3, "B", "Z")], "n int, a string, b string")
    judged = create_rows(batch, batch.select("a", "b").limit(0), [["a"], ["b"]], "n")
    assert {r.n: r.reason for r in judged.collect()} == {1: None, 2: "conflict on b", 3: None}


def test_batch_create_rules_and_references(spark):
    batch = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "b", 9), (4, "c", None)], "n int, k string, p int")
    parents = spark.createDataFrame([(1,), (2,)], "id int")
    rules = [Q.Rule("n is 1", F.col("n") == 1)]
    judged = create_rows(batch, batch.select("k").limit(0), [["k"]], "n", rules, [ForeignKey("p", parents, "id")])
    assert {r.n: r.reason for r in judged.collect()} == {1: "n is 1", 2: None, 3: "unknown p", 4: None}


def test_replace_rows(spark):
    table = spark.createDataFrame([(1, "a", "t0"), (2, "b", "t0")], "id int, v string, at string")
    batch = spark.createDataFrame([(2, None, "x"), (3, "c", "x")], "id int, v string, at string")
    after, missing = replace_rows(table, batch, "id", {"at": F.lit("t1")})
    assert {tuple(r) for r in after.collect()} == {(1, "a", "t0"), (2, None, "t1")}
    assert [r.id for r in missing.collect()] == [3]


def test_rules(spark):
    df = spark.createDataFrame([(1, -5.0, "ok"), (2, None, ""), (3, 1e13, "toolong"), (4, 3.0, None)], "id int, v double, s string")
    rules = [Q.at_least("v", 0), Q.length_between("s", 1, 5), Q.fits("v", 14, 2), Q.not_null("s"), Q.between("id", 1, 3), Q.one_of("s", ["ok", ""])]
    counts = {r.rule: r.violations for r in Q.violations(df, rules).collect()}
    assert list(counts.values()) == [1, 2, 1, 1, 1, 1]
    reasons = {r.id: r.reason for r in Q.with_reasons(df, rules).collect()}
    assert reasons[1] == "v below 0" and reasons[2] == "s length outside 1..5"
    assert reasons[3] == "s length outside 1..5; v exceeds decimal(14,2); s not in ok/"
    assert reasons[4] == "s is null; id outside 1..3"


def quality_frame(spark, rows):
    return spark.createDataFrame(rows, "iso2 string, iso3 string, country_name string, population bigint, area_km2 double, source_count bigint")


def test_quality_report(spark):
    from goldspine.config import COUNTRIES, REPORT_NAMES

    same = quality_frame(spark, [("FR", "FRA", "France", 1, 1.0, 1)] * 2)
    report = Q.quality_report(same, COUNTRIES.quality, {"file": same, "api": same.limit(0)}, REPORT_NAMES).first().asDict(True)
    assert report["status"] == "failed" and report["final_rows"] == 2
    assert report["checks"]["duplicates"] == {"iso2": 1, "iso3": 1}
    assert report["source_rows"] == {"file": 2, "api": 0}
    with pytest.raises(Q.QualityFailure):
        Q.enforce(Q.quality_report(same, COUNTRIES.quality))
    bad = quality_frame(spark, [(None, "FR", None, -1, 0.0, 0), (None, "DEU", "G", None, None, 1)])
    checks = Q.quality_report(bad, COUNTRIES.quality, None, REPORT_NAMES).first().asDict(True)["checks"]
    assert checks == {
        "mandatory_nulls": {"iso2": 2, "iso3": 0, "country_name": 1}, "duplicates": {"iso2": 1, "iso3": 0},
        "invalid_iso2": 2, "invalid_iso3": 1, "negative_population": 1, "non_positive_area": 1, "rows_below_minimum_sources": 1,
    }
    good = quality_frame(spark, [("FR", "FRA", "France", 0, None, 1)])
    assert Q.enforce(Q.quality_report(good, COUNTRIES.quality, None, REPORT_NAMES))["status"] == "passed"


def test_access(spark):
    df = spark.range(30).select("id", F.concat(F.lit("Name "), "id").alias("name"))
    assert [r.id for r in access.list_page(df, "id", 3, 2, "name", "NAME 1").collect()] == [11, 12, 13]
    assert [r.id for r in access.page_after(df, "id", 27, 10).collect()] == [28, 29]
    assert [r.id for r in access.page_after(df, "id", None, 2).collect()] == [0, 1]
    assert access.get(df, "id", 4).first().name == "Name 4"
    with pytest.raises(access.NotFound):
        access.get(df, "id", 400)
    for bad in (dict(limit=0), dict(limit=501), dict(offset=-1)):
        with pytest.raises(ValueError):
            access.list_page(df, "id", **bad)
    with pytest.raises(ValueError):
        access.search(df, "name", "x" * 151)
    ids = spark.createDataFrame([(1,), (1,), (99,)], "id bigint")
    found = sorted((r.id, r.found, r.name) for r in access.get_many(df, ids, "id").collect() if r.found)
    assert found == [(1, True, "Name 1")] * 2 and access.get_many(df, ids, "id").count() == 3
    assert [r.id for r in access.most_recent(df, "id", 2, 1).collect()] == [28, 27]

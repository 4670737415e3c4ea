"""Upserts, star tables, referential actions, batches of edits, and rule checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from goldspine.operators import quality as Q
from goldspine.operators.crud import REASON, ForeignKey, create_rows, judge_replacements, replace_rows, split
from goldspine.operators.joins import childless, orphans
from goldspine.operators.referential import cascade_delete, cascade_key, delete_rows, set_null
from goldspine.operators.upsert import CHANGE, new_keys, resolve_ids, upsert
from goldspine.plans import validation
from goldspine.plans.star_load import extend_dimension, upsert_with_ids
from goldspine.suite.tables import customers, read


def _upserted(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers updated and extended by the customers of the same number."""
    target = read(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("entity"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"),
        F.col("s_acctbal").alias("balance"), (F.col("s_acctbal") > 0).alias("active"),
    )
    incoming = read(spark, sf, "customer").select(
        F.col("c_custkey").alias("entity"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    return upsert(target, incoming, ["entity"], on_update={"active": F.lit(True)}, on_insert={"active": F.lit(True)})


def upsert_merge(spark: SparkSession, sf: str) -> DataFrame:
    return _upserted(spark, sf).withColumnRenamed(CHANGE, "change")


def load_counters(spark: SparkSession, sf: str) -> DataFrame:
    change = F.col(CHANGE)
    return _upserted(spark, sf).agg(
        F.count("*").alias("rows_after"),
        F.count_if(change == "inserted").alias("inserted"),
        F.count_if(change == "updated").alias("updated"),
    )


def star_load_dims(spark: SparkSession, sf: str) -> DataFrame:
    """Regions known from the table plus part types as new ones."""
    now = F.current_timestamp()
    known = read(spark, sf, "region").select(
        F.col("r_regionkey").cast("bigint").alias("region_id"), F.col("r_name").alias("region_name"), now.alias("created_at")
    )
    wanted = customers(spark, sf).select("region_name").unionAll(read(spark, sf, "part").select("p_type"))
    top = F.lit(known.agg(F.max("region_id")).first()[0])
    extended = extend_dimension(known, wanted, ["region_name"], "region_id", now)
    return extended.select(
        "region_name",
        F.when(F.col("region_id") <= top, F.col("region_id")).alias("known_id"),
        (F.col("region_id") > top).alias("is_new"),
    )


def star_load_subregions(spark: SparkSession, sf: str) -> DataFrame:
    """Customer subregions under the ids of their regions."""
    region = read(spark, sf, "region").select(F.col("r_regionkey").cast("bigint").alias("region_id"), F.col("r_name").alias("region_name"))
    named = customers(spark, sf).select("c_custkey", "region_name", "subregion_name")
    resolved = resolve_ids(named, region, ["region_name"], "region_id")
    none = resolved.select("region_id", "subregion_name").limit(0)
    return new_keys(resolved, none, ["region_id", "subregion_name"])


def _yearly(spark: SparkSession, sf: str, finished: bool) -> DataFrame:
    orders = read(spark, sf, "orders").where((F.col("o_orderstatus") == "F") == F.lit(finished))
    return orders.groupBy(F.col("o_custkey").alias("country_id"), F.year("o_orderdate").alias("indicator_year")).agg(
        F.count("*").alias("population"), F.sum(F.col("o_totalprice").cast("decimal(22,2)")).cast("decimal(22,2)").alias("gdp_usd")
    )


def star_load_fact(spark: SparkSession, sf: str) -> DataFrame:
    """Yearly order totals: finished orders are stored, all others are loaded."""
    stored = _yearly(spark, sf, True).select(
        (F.col("country_id") * 10000 + F.col("indicator_year")).alias("fact_id"), "country_id", "indicator_year",
        "population", "gdp_usd", F.lit("stored").alias("loaded_at"),
    )
    incoming = _yearly(spark, sf, False).where(F.coalesce("population", "gdp_usd").isNotNull())
    merged, start = upsert_with_ids(stored, incoming, ["country_id", "indicator_year"], "fact_id", F.lit("loaded"))
    expected = F.col("country_id") * 10000 + F.col("indicator_year")
    return merged.select(
        "country_id", "indicator_year", "population", F.col("gdp_usd").cast("double").alias("gdp_usd"), "loaded_at",
        ((F.col("fact_id") > start) | (F.col("fact_id") == expected)).alias("id_ok"),
        (F.col("fact_id") > start).alias("is_new"),
    )


def _negative(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "customer").where(F.col("c_acctbal") < 0).select("c_custkey")


def delete_restrict(spark: SparkSession, sf: str) -> DataFrame:
    """Delete the customers numbered like large parts; those with events stay."""
    ids = read(spark, sf, "part").where(F.col("p_size") >= 30).select(F.col("p_partkey").alias("c_custkey"))
    outcome = delete_rows(read(spark, sf, "customer"), ids, "c_custkey", read(spark, sf, "events"), "user_id")

    def labelled(rows: DataFrame, label: str) -> DataFrame:
        return rows.select("c_custkey", F.lit(label).alias("outcome"))

    return (
        labelled(outcome.remaining, "remaining")
        .unionAll(labelled(outcome.deleted, "deleted"))
        .unionAll(labelled(outcome.blocked, "blocked"))
        .unionAll(labelled(outcome.missing, "missing"))
    )


def delete_set_null(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return set_null(orders, _negative(spark, sf), "o_custkey", "c_custkey")


def delete_cascade(spark: SparkSession, sf: str) -> DataFrame:
    events = read(spark, sf, "events").select("event_id", "user_id", "event_type")
    return cascade_delete(events, _negative(spark, sf), "user_id", "c_custkey")


def key_update_cascade(spark: SparkSession, sf: str) -> DataFrame:
    """Customers in debt get new numbers; their orders follow."""
    moves = _negative(spark, sf).select(
        F.col("c_custkey").alias("old_key"), (F.col("c_custkey") + 1_000_000_000).alias("new_key")
    )
    return cascade_key(read(spark, sf, "orders").select("o_orderkey", "o_custkey"), moves, "o_custkey")


def batch_create_split(spark: SparkSession, sf: str) -> DataFrame:
    """Events as new rows: by rules, by reference to a supplier, one per user and type."""
    events = read(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    stored = events.where(F.col("value") > 90).select("user_id", "event_type")
    batch = events.where(F.col("value") <= 90)
    rules = [Q.above("value", 5), Q.one_of("event_type", ("click", "view", "purchase", "error"))]
    suppliers = ForeignKey("user_id", read(spark, sf, "supplier"), "s_suppkey")
    judged = create_rows(batch, stored, [["user_id", "event_type"]], "event_id", rules, [suppliers])
    return judged.select("event_id", "user_id", "event_type", "reason")


def batch_create_two_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as new rows under two unique keys that chain a thousand of them; cheap ones break a rule, some are stored."""
    number = F.col("o_orderkey")
    group, place = F.floor(number / 1000) * 1000, number % 1000
    orders = read(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", (group + F.floor(place / 2)).alias("a"), (group + F.floor((place + 1) / 2)).alias("b")
    )
    stored = orders.where(number % 5000 == 17).select("a", "b")
    judged = create_rows(orders.where(number % 5000 != 17), stored, [["a"], ["b"]], "o_orderkey", [Q.at_least("o_totalprice", 1500)])
    return judged.select("o_orderkey", "reason")


def batch_replace_unique(spark: SparkSession, sf: str) -> DataFrame:
    """Customers that each take over a key of the next one, a thousand in a chain, behind those that may not change.

    Every third wants the second key of the next one, which gives it up, the others the first. Numbers of parts
    beyond the customers are unknown ids.
    """
    number = F.col("c_custkey")
    stored = read(spark, sf, "customer").select(
        number.alias("id"), (number * 2).alias("a"), (-number).alias("b"), "c_acctbal"
    )
    free, last = F.col("id") + 1_000_000_000, F.col("id") % 1000 == 0
    third = F.col("id") % 3 == 0
    batch = stored.select(
        "id", F.when(third | last, free).otherwise(F.col("id") * 2 + 2).alias("a"),
        F.when(third & ~last, -F.col("id") - 1).when(F.col("id") % 3 == 1, -free).otherwise(F.col("b")).alias("b"), "c_acctbal",
    )
    parts = read(spark, sf, "part").select(F.col("p_partkey").alias("id"))
    unknown = parts.join(stored, "id", "left_anti").select("id", F.lit("not found").alias(REASON))
    judged = judge_replacements(batch, stored, [["a"], ["b"]], "id", [Q.at_least("c_acctbal", -980)])
    accepted, rejected = split(judged)
    return accepted.select("id", F.lit(None).cast("string").alias(REASON)).unionByName(rejected.select("id", REASON)).unionByName(unknown)


def batch_replace(spark: SparkSession, sf: str) -> DataFrame:
    """Customers replaced whole by the parts of the same number."""
    table = read(spark, sf, "customer").withColumn("loaded_at", F.lit("before"))
    batch = read(spark, sf, "part").select(
        F.col("p_partkey").alias("c_custkey"), F.col("p_name").alias("c_name"), F.col("p_size").alias("c_nationkey"),
        F.col("p_retailprice").alias("c_acctbal"), F.col("p_type").alias("c_mktsegment"), F.lit("before").alias("loaded_at"),
    )
    after, missing = replace_rows(table, batch, "c_custkey", {"loaded_at": F.lit("after")})
    return after.unionByName(missing.withColumn("loaded_at", F.lit("not found")))


def orphan_check(spark: SparkSession, sf: str) -> DataFrame:
    orders = childless(read(spark, sf, "orders"), read(spark, sf, "lineitem"), "o_orderkey", "l_orderkey")
    documents = childless(read(spark, sf, "documents"), read(spark, sf, "labels"), "doc_id", "doc_id")
    idle = childless(read(spark, sf, "customer"), read(spark, sf, "events"), "c_custkey", "user_id")

    def labelled(rows: DataFrame, key: str, label: str) -> DataFrame:
        return rows.select(F.lit(label).alias("kind"), F.col(key).alias("id"))

    return (
        labelled(orders, "o_orderkey", "order without line")
        .unionAll(labelled(documents, "doc_id", "document without label"))
        .unionAll(labelled(idle, "c_custkey", "customer without event"))
    )


def foreign_key_orphans(spark: SparkSession, sf: str) -> DataFrame:
    events = read(spark, sf, "events").select("event_id", "user_id")
    return orphans(events, read(spark, sf, "supplier"), "user_id", "s_suppkey")


def _order_rules() -> list[Q.Rule]:
    return [
        Q.at_least("o_totalprice", 50_000),
        Q.above("o_custkey", 10),
        Q.between("o_year", 1993, 2000),
        Q.one_of("o_orderstatus", ("O", "F")),
        Q.length_between("o_orderpriority", 1, 8),
        Q.code_format("o_orderstatus", 2),
        Q.not_null("o_orderdate"),
        Q.not_blank("o_orderpriority"),
        Q.fits("o_totalprice", 7, 2),
    ]


def _ruled_orders(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "orders").withColumn("o_year", F.year("o_orderdate"))


def range_violations(spark: SparkSession, sf: str) -> DataFrame:
    broken = Q.any_broken([Q.at_least("c_acctbal", 0), Q.between("c_nationkey", 1, 23)])
    return read(spark, sf, "customer").where(broken)


def rule_violations(spark: SparkSession, sf: str) -> DataFrame:
    return Q.violations(_ruled_orders(spark, sf), _order_rules())


def rule_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return Q.with_reasons(_ruled_orders(spark, sf), _order_rules()).select("o_orderkey", "reason")


def post_load_validation(spark: SparkSession, sf: str) -> DataFrame:
    """The checks after a load, as counts, on customers under nations with orders as facts."""
    customer, orders = read(spark, sf, "customer"), read(spark, sf, "orders")
    checks = {
        "orphan_group": orphans(customer, read(spark, sf, "nation"), "c_nationkey", "n_nationkey"),
        "orphan_fact": orphans(orders, customer, "o_custkey", "c_custkey"),
        "orphan_event": orphans(read(spark, sf, "events"), read(spark, sf, "supplier"), "user_id", "s_suppkey"),
        "bad_values": _ruled_orders(spark, sf).where(
            Q.any_broken([Q.at_least("o_totalprice", 0), Q.between("o_year", 1995, 2100)])
        ),
    }
    counted = None
    for name, rows in checks.items():
        one = rows.agg(F.lit(name).alias("check"), F.count("*").alias("rows"))
        counted = one if counted is None else counted.unionAll(one)
    return counted


def post_load_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that each check of a finished load returns, on customers as countries and orders as indicators."""
    nation, customer = read(spark, sf, "nation"), read(spark, sf, "customer")
    checks = validation.post_load_checks(
        read(spark, sf, "region").select(F.col("r_regionkey").alias("region_id")),
        nation.select(F.col("n_nationkey").alias("subregion_id")),
        customer.select(
            F.col("c_custkey").alias("country_id"), F.col("c_name").alias("iso2"), F.col("c_name").alias("iso3"),
            (F.col("c_custkey") % 7).alias("region_id"), (F.col("c_nationkey") + F.col("c_custkey") % 3).alias("subregion_id"),
        ),
        read(spark, sf, "orders").select(
            F.col("o_orderkey").alias("country_indicator_id"), (F.col("o_custkey") + F.col("o_orderkey") % 2).alias("country_id"),
            F.year("o_orderdate").alias("indicator_year"), (F.col("o_orderkey") % 11 - 1).alias("population"),
            F.col("o_totalprice").alias("area_km2"), (F.col("o_totalprice") - 2000).alias("gdp_usd"),
        ),
        read(spark, sf, "events").select(F.col("event_id").alias("load_id"), F.col("ts").alias("started_at")),
    )
    counted = [rows.agg(F.lit(name).alias("check"), F.count("*").alias("rows")) for name, rows in checks.items()]
    return reduce(DataFrame.unionAll, counted)


QUERIES = {
    "upsert_merge": upsert_merge,
    "load_counters": load_counters,
    "star_load_dims": star_load_dims,
    "star_load_subregions": star_load_subregions,
    "star_load_fact": star_load_fact,
    "delete_restrict": delete_restrict,
    "delete_set_null": delete_set_null,
    "delete_cascade": delete_cascade,
    "key_update_cascade": key_update_cascade,
    "batch_create_split": batch_create_split,
    "batch_create_two_keys": batch_create_two_keys,
    "batch_replace": batch_replace,
    "batch_replace_unique": batch_replace_unique,
    "orphan_check": orphan_check,
    "foreign_key_orphans": foreign_key_orphans,
    "range_violations": range_violations,
    "rule_violations": rule_violations,
    "rule_reasons": rule_reasons,
    "post_load_validation": post_load_validation,
    "post_load_checks": post_load_checks,
}

_UPSERT = """
    SELECT coalesce(s_suppkey, c_custkey) AS entity,
           CASE WHEN c_custkey IS NOT NULL THEN c_name ELSE s_name END AS name, s_nationkey AS nation,
           CASE WHEN c_custkey IS NOT NULL THEN c_acctbal ELSE s_acctbal END AS balance,
           CASE WHEN c_custkey IS NOT NULL THEN true ELSE s_acctbal > 0 END AS active,
           CASE WHEN s_suppkey IS NULL THEN 'inserted' WHEN c_custkey IS NOT NULL THEN 'updated' ELSE 'kept' END AS change
    FROM supplier FULL JOIN customer ON s_suppkey = c_custkey
"""
_RULES = {
    "o_totalprice below 50000": "o_totalprice < 50000",
    "o_custkey not above 10": "o_custkey <= 10",
    "o_year outside 1993..2000": "year(o_orderdate) NOT BETWEEN 1993 AND 2000",
    "o_orderstatus not in O/F": "o_orderstatus NOT IN ('O', 'F')",
    "o_orderpriority length outside 1..8": "length(o_orderpriority) NOT BETWEEN 1 AND 8",
    "o_orderstatus is not 2 capital letters": "NOT regexp_full_match(o_orderstatus, '[A-Z]{2}')",
    "o_orderdate is null": "o_orderdate IS NULL",
    "o_orderpriority is blank": "trim(o_orderpriority) = ''",
    "o_totalprice exceeds decimal(7,2)": "o_totalprice >= 99999.995",
}
_DEBT = "(SELECT c_custkey FROM customer WHERE c_acctbal < 0)"

ORACLES = {
    "upsert_merge": _UPSERT,
    "load_counters": f"""
        SELECT count(*) AS rows_after, count(*) FILTER (WHERE change = 'inserted') AS inserted,
               count(*) FILTER (WHERE change = 'updated') AS updated FROM ({_UPSERT})
    """,
    "star_load_dims": """
        SELECT r_name AS region_name, CAST(r_regionkey AS BIGINT) AS known_id, false AS is_new FROM region
        UNION ALL SELECT DISTINCT p_type, CAST(NULL AS BIGINT), true FROM part
    """,
    "star_load_subregions": """
        SELECT DISTINCT CAST(n_regionkey AS BIGINT) AS region_id, n_name AS subregion_name
        FROM nation JOIN customer ON c_nationkey = n_nationkey
    """,
    "star_load_fact": """
        WITH yearly AS (
            SELECT o_orderstatus = 'F' AS finished, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS n,
                   CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) / 100 AS total
            FROM orders GROUP BY ALL
        ), stored AS (SELECT * FROM yearly WHERE finished),
        incoming AS (SELECT * FROM yearly WHERE NOT finished)
        SELECT coalesce(s.o_custkey, i.o_custkey) AS country_id, coalesce(s.y, i.y) AS indicator_year,
               coalesce(i.n, s.n) AS population, coalesce(i.total, s.total) AS gdp_usd,
               CASE WHEN i.n IS NOT NULL THEN 'loaded' ELSE 'stored' END AS loaded_at,
               true AS id_ok, s.n IS NULL AS is_new
        FROM stored s FULL JOIN incoming i ON s.o_custkey = i.o_custkey AND s.y = i.y
    """,
    "delete_restrict": """
        WITH ids AS (SELECT p_partkey AS k FROM part WHERE p_size >= 30),
        judged AS (
            SELECT k, CASE WHEN k NOT IN (SELECT c_custkey FROM customer) THEN 'missing'
                           WHEN k IN (SELECT user_id FROM events) THEN 'blocked' ELSE 'deleted' END AS outcome FROM ids
        )
        SELECT c_custkey, 'remaining' AS outcome FROM customer
        WHERE c_custkey NOT IN (SELECT k FROM judged WHERE outcome = 'deleted')
        UNION ALL SELECT k, outcome FROM judged
    """,
    "delete_set_null": f"""
        SELECT o_orderkey, CASE WHEN o_custkey NOT IN {_DEBT} THEN o_custkey END AS o_custkey, o_totalprice FROM orders
    """,
    "delete_cascade": f"SELECT event_id, user_id, event_type FROM events WHERE user_id NOT IN {_DEBT}",
    "key_update_cascade": f"""
        SELECT o_orderkey, CASE WHEN o_custkey IN {_DEBT} THEN o_custkey + 1000000000 ELSE o_custkey END AS o_custkey
        FROM orders
    """,
    "batch_create_split": """
        WITH batch AS (
            SELECT event_id, user_id, event_type, nullif(concat_ws('; ',
                       CASE WHEN value <= 5 THEN 'value not above 5' END,
                       CASE WHEN event_type NOT IN ('click', 'view', 'purchase', 'error')
                            THEN 'event_type not in click/view/purchase/error' END), '') AS broken
            FROM events WHERE value <= 90
        ), referred AS (
            SELECT event_id, user_id, event_type, coalesce(broken,
                       CASE WHEN user_id NOT IN (SELECT s_suppkey FROM supplier) THEN 'unknown user_id' END) AS broken
            FROM batch
        ), firsts AS (
            SELECT user_id, event_type, min(event_id) AS first_id FROM referred
            WHERE broken IS NULL AND (user_id, event_type) NOT IN (SELECT (user_id, event_type) FROM events WHERE value > 90)
            GROUP BY user_id, event_type
        )
        SELECT r.event_id, r.user_id, r.event_type, coalesce(broken,
                   CASE WHEN f.first_id IS NULL THEN 'conflict on user_id, event_type' END) AS reason
        FROM referred r LEFT JOIN firsts f ON f.first_id = r.event_id
    """,
    # In a chain neighbours share a key by turns, so of a run without gaps every second row is taken.
    "batch_create_two_keys": """
        WITH rows AS (
            SELECT o_orderkey AS k, o_orderkey % 5000 = 17 AS stored, o_totalprice < 1500 AS cheap, o_orderkey // 1000 AS g FROM orders
        ), near AS (
            SELECT r.k, r.g, r.cheap, p.k IS NOT NULL AS before, n.k IS NOT NULL AS behind FROM rows r
            LEFT JOIN (SELECT k + 1 AS k, g FROM rows WHERE stored) p USING (k, g)
            LEFT JOIN (SELECT k - 1 AS k, g FROM rows WHERE stored) n USING (k, g) WHERE NOT r.stored
        ), open AS (
            SELECT *, k - row_number() OVER (PARTITION BY g ORDER BY k) AS run FROM near WHERE NOT (cheap OR before OR behind)
        ), settled AS (
            SELECT k, (k - min(k) OVER (PARTITION BY g, run)) % 2 = 0 AS taken FROM open
        )
        SELECT n.k AS o_orderkey, CASE
                 WHEN cheap THEN 'o_totalprice below 1500'
                 WHEN taken THEN NULL
                 WHEN k % 2 = 1 AND (before OR taken IS NOT NULL OR p.t) THEN 'conflict on a'
                 WHEN k % 2 = 0 AND behind THEN 'conflict on a'
                 ELSE 'conflict on b' END AS reason
        FROM near n LEFT JOIN settled USING (k) LEFT JOIN (SELECT k + 1 AS k, taken AS t, (k + 1) // 1000 AS g FROM settled) p USING (k, g)
    """,
    "batch_replace_unique": """
        WITH judged AS (
            SELECT c_custkey AS id, c_acctbal < -980 AS broken,
                   bool_or(c_acctbal < -980) OVER (PARTITION BY (c_custkey + 999) // 1000 ORDER BY c_custkey DESC) AS reached
            FROM customer
        )
        SELECT id, CASE WHEN broken THEN 'c_acctbal below -980' WHEN NOT reached THEN NULL
                        WHEN id % 3 = 0 THEN 'conflict on b' ELSE 'conflict on a' END AS reason
        FROM judged
        UNION ALL SELECT p_partkey, 'not found' FROM part WHERE p_partkey NOT IN (SELECT c_custkey FROM customer)
    """,
    "batch_replace": """
        SELECT c_custkey, coalesce(p_name, c_name) AS c_name, coalesce(p_size, c_nationkey) AS c_nationkey,
               coalesce(p_retailprice, c_acctbal) AS c_acctbal, coalesce(p_type, c_mktsegment) AS c_mktsegment,
               CASE WHEN p_partkey IS NULL THEN 'before' ELSE 'after' END AS loaded_at
        FROM customer LEFT JOIN part ON p_partkey = c_custkey
        UNION ALL SELECT p_partkey, p_name, p_size, p_retailprice, p_type, 'not found' FROM part
        WHERE p_partkey NOT IN (SELECT c_custkey FROM customer)
    """,
    "orphan_check": """
        SELECT 'order without line' AS kind, o_orderkey AS id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
        UNION ALL SELECT 'document without label', doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
        UNION ALL SELECT 'customer without event', c_custkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)
    """,
    "foreign_key_orphans": """
        SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)
    """,
    "range_violations": "SELECT * FROM customer WHERE c_acctbal < 0 OR c_nationkey NOT BETWEEN 1 AND 23",
    "rule_violations": " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {test}) AS violations FROM orders" for name, test in _RULES.items()
    ),
    "rule_reasons": "SELECT o_orderkey, nullif(concat_ws('; ', "
    + ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in _RULES.items())
    + "), '') AS reason FROM orders",
    "post_load_validation": """
        SELECT 'orphan_group' AS check, count(*) AS rows FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation)
        UNION ALL SELECT 'orphan_fact', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
        UNION ALL SELECT 'orphan_event', count(*) FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)
        UNION ALL SELECT 'bad_values', count(*) FROM orders WHERE o_totalprice < 0 OR year(o_orderdate) NOT BETWEEN 1995 AND 2100
    """,
    "post_load_checks": """
        SELECT 'keys' AS check, 1::BIGINT AS rows
        UNION ALL SELECT 'orphan_region', count(*) FROM customer WHERE c_custkey % 7 NOT IN (SELECT r_regionkey FROM region)
        UNION ALL SELECT 'orphan_subregion', count(*) FROM customer WHERE c_nationkey + c_custkey % 3 NOT IN (SELECT n_nationkey FROM nation)
        UNION ALL SELECT 'orphan_indicator', count(*) FROM orders WHERE o_custkey + o_orderkey % 2 NOT IN (SELECT c_custkey FROM customer)
        UNION ALL SELECT 'bad_values', count(*) FROM orders
            WHERE o_orderkey % 11 = 0 OR o_totalprice <= 0 OR o_totalprice < 2000 OR year(o_orderdate) NOT BETWEEN YEARS
        UNION ALL SELECT 'last_load', 1
    """.replace("YEARS", "{} AND {}".format(*Q.YEAR_RANGE)),
}

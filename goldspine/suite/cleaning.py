"""Cleaning of names, codes, numbers, JSON values, collections and repeated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from goldspine.functions import variants as V
from goldspine.functions.collections import serialize
from goldspine.functions.numbers import frame_ratio, grouped_integer, to_double, to_integer
from goldspine.functions.text import (
    apply_aliases, clean_code, drop_footnotes, is_blank, is_code, normalize_name, upper_letters,
)
from goldspine.operators.dedupe import duplicate_keys, keep_last
from goldspine.suite.tables import as_double, day, read

ALIASES = {"Red Widget": "crimson widget", "old rod": "antique rod", "COLD  ring": "ice ring"}
TEXT = T.StringType()


def normalize_names(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "documents").select("doc_id", normalize_name(F.col("text")).alias("name_key"))


def alias_names(spark: SparkSession, sf: str) -> DataFrame:
    key = apply_aliases(normalize_name(F.col("p_name")), ALIASES)
    return read(spark, sf, "part").select("p_partkey", key.alias("part_key"))


def clean_codes(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "part").select(
        "p_partkey",
        clean_code(F.col("p_brand"), 5).alias("brand_code"),
        clean_code(F.col("p_type"), 6).alias("type_code"),
        is_code(F.col("p_type"), 5).alias("type_is_code"),
        upper_letters(F.col("p_brand")).alias("brand_letters"),
        upper_letters(F.lower("p_type")).alias("type_letters"),
    )


def lenient_numbers(spark: SparkSession, sf: str) -> DataFrame:
    grouped = F.format_number("o_totalprice", 2)
    shown = F.format_number(F.col("o_orderkey") * 1000 + F.col("o_custkey"), 0)
    return read(spark, sf, "orders").select(
        "o_orderkey",
        to_double(F.replace(F.replace(grouped, F.lit(","), F.lit(" ")), F.lit("."), F.lit(",")), TEXT).alias("continental"),
        to_double(grouped, TEXT).alias("two_marks"),
        grouped_integer(F.concat(F.lit(" "), shown, F.lit(" [1]"))).alias("footnoted"),
        grouped_integer(F.concat(shown, F.lit(" est."))).alias("not_a_count"),
        to_integer(F.concat(F.lit("no. "), F.col("o_orderkey")), TEXT).alias("embedded"),
        to_integer(F.concat_ws("-", "o_custkey", "o_orderkey"), TEXT).alias("hyphenated"),
        to_integer(F.col("o_totalprice"), T.DoubleType()).alias("rounded"),
    )


def json_paths(spark: SparkSession, sf: str) -> DataFrame:
    label = F.to_json(F.struct("event_type"))
    text = F.concat(
        F.lit('{"outer":'), F.col("props"), F.lit(',"label":'), label, F.lit(',"empty":"","list":[],"none":null}')
    )
    doc = F.col("doc")
    return read(spark, sf, "events").select("event_id", F.try_parse_json(text).alias("doc")).select(
        "event_id",
        V.integer(V.at(doc, ("outer", "k"))).alias("nested"),
        V.first_text(doc, [("absent",), ("empty",), ("list",), ("none",), ("label", "event_type")]).alias("first_filled"),
        V.first_text(doc, [("outer",), ("label", "event_type")]).alias("object_is_no_text"),
        V.scalar_text(V.at(doc, ("outer", "k", "deeper"))).alias("beyond_scalar"),
    )


def collection_serialize(spark: SparkSession, sf: str) -> DataFrame:
    # A user's set holds at most the few event types that exist.
    kinds = read(spark, sf, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("kinds"))
    return kinds.select(
        "user_id",
        serialize(F.col("kinds"), T.ArrayType(TEXT)).alias("event_types"),
        serialize(F.map_from_arrays("kinds", "kinds"), T.MapType(TEXT, TEXT)).alias("type_keys"),
        serialize(F.array(F.lit(" "), F.lit(None)), T.ArrayType(TEXT)).alias("nothing"),
    )


def footnoted_names(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat(F.lit(" "), F.col("c_name"), F.lit(" [note "), F.col("c_nationkey"), F.lit("]\n"))
    return read(spark, sf, "customer").select(
        "c_custkey",
        drop_footnotes(name).alias("plain_name"),
        is_blank(F.when(F.col("c_acctbal") < 0, F.lit(" \t ")).otherwise(F.col("c_name"))).alias("blank"),
    )


def dedupe_keep_last(spark: SparkSession, sf: str) -> DataFrame:
    lines = read(spark, sf, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    rest = [c for c in ("l_shipdate", *sorted(set(lines.columns) - set(keys) - {"l_shipdate"}))]
    return keep_last(lines, keys, rest).withColumn("l_shipdate", day("l_shipdate"))


def repeated_keys(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_keys(read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def derived_ratios(spark: SparkSession, sf: str) -> DataFrame:
    part = read(spark, sf, "part")
    sized = part.withColumn("space", F.when(F.col("p_size") > 25, 0.0).otherwise(F.col("p_size") * 0.25))
    ratios = sized.select(
        "p_partkey",
        frame_ratio(sized, "p_retailprice", "p_size").alias("price_per_size"),
        frame_ratio(sized, "p_size", "space").alias("size_per_space"),
    )
    return as_double(ratios, "price_per_size", "size_per_space")


QUERIES = {
    "normalize_names": normalize_names,
    "alias_names": alias_names,
    "clean_codes": clean_codes,
    "lenient_numbers": lenient_numbers,
    "json_paths": json_paths,
    "collection_serialize": collection_serialize,
    "footnoted_names": footnoted_names,
    "dedupe_keep_last": dedupe_keep_last,
    "repeated_keys": repeated_keys,
    "derived_ratios": derived_ratios,
}

_LINE_COLUMNS = (
    "l_discount", "l_extendedprice", "l_linestatus", "l_partkey", "l_quantity", "l_returnflag", "l_suppkey", "l_tax",
)

ORACLES = {
    "normalize_names": r"""
        SELECT doc_id, nullif(trim(regexp_replace(regexp_replace(
            strip_accents(lower(replace(text, 'ß', 'ss'))), '\[[^\]]*\]', '', 'g'),
            '[^a-z0-9]+', ' ', 'g')), '') AS name_key
        FROM documents
    """,
    "alias_names": """
        SELECT p_partkey, CASE lower(p_name) WHEN 'red widget' THEN 'crimson widget'
            WHEN 'old rod' THEN 'antique rod' WHEN 'cold ring' THEN 'ice ring' ELSE lower(p_name) END AS part_key
        FROM part
    """,
    "clean_codes": r"""
        SELECT p_partkey,
               CASE WHEN length(regexp_replace(p_brand, '[^A-Za-z]', '', 'g')) = 5
                    THEN upper(regexp_replace(p_brand, '[^A-Za-z]', '', 'g')) END AS brand_code,
               CASE WHEN length(regexp_replace(p_type, '[^A-Za-z]', '', 'g')) = 6
                    THEN upper(regexp_replace(p_type, '[^A-Za-z]', '', 'g')) END AS type_code,
               regexp_full_match(p_type, '[A-Z]{5}') AS type_is_code,
               CASE WHEN regexp_full_match(p_brand, '[A-Za-z]+') THEN upper(p_brand) END AS brand_letters,
               CASE WHEN regexp_full_match(p_type, '[A-Za-z]+') THEN upper(p_type) END AS type_letters
        FROM part
    """,
    "lenient_numbers": """
        SELECT o_orderkey, o_totalprice AS continental,
               CASE WHEN o_totalprice < 999.995 THEN o_totalprice END AS two_marks,
               o_orderkey * 1000 + o_custkey AS footnoted,
               CAST(NULL AS BIGINT) AS not_a_count,
               o_orderkey AS embedded,
               CAST(NULL AS BIGINT) AS hyphenated,
               CAST((CAST(round(o_totalprice * 100) AS BIGINT) + 50) // 100 AS BIGINT) AS rounded
        FROM orders
    """,
    "json_paths": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS nested,
               event_type AS first_filled, CAST(NULL AS VARCHAR) AS object_is_no_text,
               CAST(NULL AS VARCHAR) AS beyond_scalar
        FROM events
    """,
    "collection_serialize": """
        SELECT user_id, string_agg(DISTINCT event_type, '|' ORDER BY event_type) AS event_types,
               string_agg(DISTINCT event_type, '|' ORDER BY event_type) AS type_keys,
               CAST(NULL AS VARCHAR) AS nothing
        FROM events GROUP BY user_id
    """,
    "footnoted_names": "SELECT c_custkey, c_name AS plain_name, c_acctbal < 0 AS blank FROM customer",
    "dedupe_keep_last": f"""
        SELECT l_orderkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate,
               {", ".join(_LINE_COLUMNS)}
        FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY lineitem.l_shipdate DESC, {", ".join(c + " DESC" for c in _LINE_COLUMNS)}) = 1
    """,
    "repeated_keys": """
        SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    """,
    "derived_ratios": """
        SELECT p_partkey,
               CASE WHEN p_size = 0 THEN NULL ELSE
                   CAST((2 * CAST(round(p_retailprice * 100) AS BIGINT) + p_size) // (2 * p_size) AS DOUBLE) / 100
               END AS price_per_size,
               CASE WHEN p_size > 25 OR p_size = 0 THEN NULL ELSE 4.0::DOUBLE END AS size_per_space
        FROM part
    """,
}

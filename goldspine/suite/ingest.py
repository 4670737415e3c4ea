"""Captured pages, HTML tables, written files and their fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from goldspine.functions.collections import SEPARATOR
from goldspine.operators.aggregates import rows_per_source
from goldspine.sinks.documents import lineage, write_table
from goldspine.sinks.staging import stage, staging_path
from goldspine.sources.files import fingerprints, read_csv, read_json, read_parquet, stored_bytes, write_raw
from goldspine.sources.html import clean_rows, raw_rows
from goldspine.sources.manifest import compare_entries, file_entries, newest_output
from goldspine.sources.pages import explode_objects, normalize_records, parse_pages, protocol_summary
from goldspine.suite.tables import NAMES, customers, day, read


def _payload() -> Column:
    """A captured page with one customer, in one of three layouts, and one stray item."""
    code = F.concat(F.lit("N"), "c_nationkey")
    size, area = F.col("c_custkey") * 1000, F.abs("c_acctbal")
    nested = F.to_json(
        F.struct(
            F.struct(code.alias("alpha_2"), F.col("c_mktsegment").alias("alpha_3")).alias("codes"),
            F.struct(F.col("c_name").alias("common"), F.concat(F.lit("Official "), "c_name").alias("official")).alias("names"),
            F.array(F.struct(F.col("subregion_name").alias("name"))).alias("capitals"),
            F.col("region_name").alias("region"),
            F.col("subregion_name").alias("subregion"),
            size.alias("population"),
            F.struct(area.alias("kilometers"), (area * 0.5).alias("miles")).alias("area"),
            F.array(F.struct(F.lit("USD").alias("code")), F.struct(F.lit("EUR").alias("code"))).alias("currencies"),
            F.array(F.struct(F.concat(F.lit(" L"), "c_nationkey").alias("name"))).alias("languages"),
        )
    )
    mixed = F.to_json(
        F.struct(
            F.lit("").alias("cca2"),
            code.alias("alpha2Code"),
            F.col("c_mktsegment").alias("cca3"),
            F.struct(F.col("c_name").alias("common"), F.concat(F.lit("Official "), "c_name").alias("official")).alias("name"),
            F.array(F.col("subregion_name")).alias("capital"),
            F.struct(F.col("region_name").alias("region"), F.col("subregion_name").alias("subregion"), area.alias("area")).alias("geography"),
            F.struct(size.alias("population")).alias("demographics"),
            F.create_map(F.lit("USD"), F.lit(1), F.lit("EUR"), F.lit(2)).alias("currencies"),
            F.array(F.concat(F.lit("L"), "c_nationkey"), F.lit(" ")).alias("languages"),
        )
    )
    flat = F.to_json(
        F.struct(
            code.alias("alpha2Code"),
            F.col("c_mktsegment").alias("alpha3Code"),
            F.col("c_name").alias("name"),
            F.col("subregion_name").alias("capital"),
            F.col("region_name").alias("region"),
            F.col("subregion_name").alias("subregion"),
            F.format_number(size, 0).alias("population"),
            area.alias("area"),
            F.array(F.lit("USD"), F.lit("EUR"), F.lit("USD")).alias("currencies"),
            F.lit("spoken").alias("languages"),
        )
    )
    record = (
        F.when(F.col("c_mktsegment") == "BUILDING", nested)
        .when(F.col("c_mktsegment").isin("MACHINERY", "HOUSEHOLD"), mixed)
        .otherwise(flat)
    )
    return F.concat(
        F.lit('{"data":{"objects":["stray",'), record, F.lit('],"meta":{"count":2,"more":'), F.col("more"), F.lit("}}}")
    )


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    last = read(spark, sf, "customer").agg(F.max("c_custkey").alias("k")).scalar()
    # A row becomes a page of text that is parsed path by path: work of its own for each, however few row groups
    # or joined rows hand them out. Dealt out before the pages are built, when rows are still narrow.
    rows = customers(spark, sf).select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "subregion_name", "region_name")
    rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.withColumn("more", F.when(F.col("c_custkey") < last, "true").otherwise("false"))
    return rows.select("c_custkey", (F.col("c_custkey") * 2).alias("page_offset"), _payload().alias("payload"))


def api_records(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parse_pages(_pages(spark, sf), "payload")
    records = normalize_records(explode_objects(parsed, "c_custkey"), "c_custkey")
    joined = {c: F.array_join(c, SEPARATOR) for c in ("currencies", "languages")}
    return records.withColumns(joined).drop("source_url", "extracted_at")


def page_protocol(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parse_pages(_pages(spark, sf), "payload")
    return protocol_summary(parsed, "page_offset").select(
        "pages", "objects", "problems", "terminal_pages", "first_offset", "end_offset", "gaps", "complete"
    )


def broken_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Each event as a page with one of the protocol's faults."""
    kind = F.col("event_type")
    fault = (
        F.when(kind == "click", F.concat(F.lit('{"data":{"objects":[],"meta":{"more":true}},"p":'), "props", F.lit("}")))
        .when(kind == "view", F.concat(F.lit('{"data":{"objects":[1],"meta":{"more":"no"}},"p":'), "props", F.lit("}")))
        .when(kind == "error", F.concat(F.lit('{"success":false,"p":'), "props", F.lit("}")))
        .when(kind == "purchase", F.concat(F.lit('{"data":{"objects":['), "props", F.lit("]}}")))
        .otherwise(F.concat(F.lit("<html>"), "props"))
    )
    pages = read(spark, sf, "events").select("event_id", "event_type", fault.alias("payload"))
    return parse_pages(pages, "payload").select("event_id", "event_type", "problem")


def _with_table(spark: SparkSession, sf: str) -> DataFrame:
    """The stored pages, each led by a table built from its own address and size."""
    safe = F.replace(F.replace(F.col("url"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    count = F.format_number(F.length("html") * 1000 + F.col("page_id"), 0)
    table = F.concat(
        F.lit('<table class="infobox"><tr><th>Country</th><th>Area</th></tr><tr><td>x</td><td>1</td></tr></table>'
              '<table class="sortable wikitable"><tr><th>Rank</th><th>Location <i>name</i></th><th>Population</th></tr>'
              "<tr><td>-</td><td>World</td><td>8,232,000,000</td></tr><tr><td>1</td><td><a href='#'>"),
        safe,
        F.lit("</a><sup>[1]</sup></td><td>"),
        count,
        F.lit("<sup>[a]</sup></td></tr><tr><td>short</td></tr><tr><td>2</td><td>Unknown</td><td>n/a</td></tr></table>"),
    )
    return read(spark, sf, "pages").select("page_id", F.concat(table, "html").alias("html"))


def html_table_rows(spark: SparkSession, sf: str) -> DataFrame:
    return clean_rows(raw_rows(_with_table(spark, sf), "html", "page_id"), "page_id")


def sink_csv(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders").withColumn("o_orderdate", day("o_orderdate"))
    note = F.when(F.col("o_orderstatus") != "P", F.concat(F.lit('a "quoted", '), "o_orderpriority"))
    path = write_table(orders.withColumn("note", note), staging_path(spark, "csv"), "csv")
    columns = "o_orderkey string, o_custkey string, note string, o_orderdate string"
    return read_csv(spark, path, columns)


def sink_json(spark: SparkSession, sf: str) -> DataFrame:
    path = write_table(read(spark, sf, "customer"), staging_path(spark, "json"), "json")
    return read_json(spark, path, "c_custkey bigint, c_name string, c_acctbal double, absent string", lines=True)


def json_array(spark: SparkSession, sf: str) -> DataFrame:
    """Customers read from files that hold an array each, one file for a segment."""
    rows = read(spark, sf, "customer")
    first = rows.groupBy("c_mktsegment").agg(F.min("c_custkey").alias("first"))
    sign = F.when(F.col("c_custkey") == F.col("first"), "[").otherwise(",")
    record = F.to_json(F.struct("c_custkey", "c_name", "c_acctbal"))
    lines = rows.join(first, "c_mktsegment").select("c_mktsegment", "c_custkey", F.concat(sign, record).alias("line"))
    ends = first.select("c_mktsegment", F.lit(None).cast("bigint").alias("c_custkey"), F.lit("]").alias("line"))
    path = staging_path(spark, "arrays")
    placed = lines.unionAll(ends).repartition("c_mktsegment").sortWithinPartitions("c_mktsegment", F.col("c_custkey").asc_nulls_last())
    placed.select("c_mktsegment", "line").write.partitionBy("c_mktsegment").text(path)
    return read_json(spark, path, "c_custkey bigint, c_name string, c_acctbal double, absent string").drop("c_mktsegment")


def newest_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Of two outputs of a job the one written last, whatever its name."""
    folder = staging_path(spark, "outputs")
    orders = read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    write_table(orders.withColumn("o_totalprice", -F.col("o_totalprice")), f"{folder}/orders_2", "parquet")
    write_table(orders, f"{folder}/orders_1", "parquet")
    return read_parquet(spark, newest_output(spark, folder, "orders_*"))


def sink_parquet(spark: SparkSession, sf: str) -> DataFrame:
    lines = read(spark, sf, "lineitem").withColumn("l_shipdate", day("l_shipdate"))
    path = write_table(lines, staging_path(spark, "parquet"), "parquet", compression="zstd")
    return read_parquet(spark, path, ("l_orderkey", "l_shipdate")).select("l_orderkey", "l_linenumber", "l_shipdate", "l_tax")


def _files(sf: str) -> dict[str, str]:
    return {name: f"{sf}/{name}.parquet" for name in NAMES}


def manifest_verify(spark: SparkSession, sf: str) -> DataFrame:
    """Customers by segment, recorded file by file; then one file changes, one goes and one comes."""
    customers_out = staging_path(spark, "segments")
    rows = read(spark, sf, "customer").withColumn("segment", F.col("c_mktsegment"))

    def write(df: DataFrame, path: str) -> None:
        df.repartition("segment").write.mode("append").partitionBy("segment").parquet(path)

    write(rows, customers_out)
    recorded = stage(file_entries(spark, {"customer": customers_out}), "recorded")
    # Other bytes under the name of the old file.
    other = staging_path(spark, "segments")
    write(rows.where(F.col("segment") == "BUILDING").withColumn("c_acctbal", -F.col("c_acctbal")), other)
    write(rows.where(F.col("segment") == "MACHINERY").withColumn("segment", F.lit("added")), customers_out)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    files = hadoop.Path(customers_out).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    first = lambda folder: files.globStatus(hadoop.Path(f"{folder}/*.parquet"))[0].getPath()
    old, new = first(f"{customers_out}/segment=BUILDING"), first(f"{other}/segment=BUILDING")
    files.delete(old, False)
    files.rename(new, old)
    files.delete(hadoop.Path(f"{customers_out}/segment=HOUSEHOLD"), True)
    states = compare_entries(recorded, file_entries(spark, {"customer": customers_out}))
    return states.select("source", F.regexp_extract("file", "segment=([^/]+)/", 1).alias("segment"), "state")


def text_hashes(spark: SparkSession, sf: str) -> DataFrame:
    """The hash of files of known text: one for each segment, of its customers' names, a line for each."""
    path = staging_path(spark, "text")
    names = read(spark, sf, "customer").repartition("c_mktsegment").sortWithinPartitions("c_custkey")
    names.select("c_mktsegment", F.concat("c_name", F.lit(" \u00e9"))).write.partitionBy("c_mktsegment").text(path)
    found = fingerprints(spark, path)
    return found.select(F.regexp_extract("path", "c_mktsegment=([^/]+)/", 1).alias("segment"), F.col("length").alias("bytes"), "sha256")


def file_lineage(spark: SparkSession, sf: str) -> DataFrame:
    files = lineage({n: read(spark, sf, n) for n in NAMES})
    return files.select("source", F.element_at(F.split("path", "/"), -1).alias("file"))


def raw_copies(spark: SparkSession, sf: str) -> DataFrame:
    """Files of known text kept as raw copies: the bytes of the copies, chunk by chunk."""
    path = staging_path(spark, "text")
    orders = read(spark, sf, "orders")
    lines = orders.select("o_orderpriority", F.concat_ws("|", "o_orderkey", "o_custkey", "o_orderstatus", F.lit("\u00e9\r")).alias("line"))
    lines.write.partitionBy("o_orderpriority").text(path)
    copies = stored_bytes(spark.read.parquet(write_raw(spark, path, staging_path(spark, "raw"))))
    folder = F.url_decode(F.regexp_extract("path", "o_orderpriority=([^/]+)/", 1))
    return copies.select(folder.alias("priority"), F.col("chunk").cast("string").alias("chunk"))


QUERIES = {
    "api_records": api_records,
    "page_protocol": page_protocol,
    "broken_pages": broken_pages,
    "html_table_rows": html_table_rows,
    "sink_csv": sink_csv,
    "sink_json": sink_json,
    "json_array": json_array,
    "newest_output": newest_orders,
    "sink_parquet": sink_parquet,
    "manifest_verify": manifest_verify,
    "file_lineage": file_lineage,
    "raw_copies": raw_copies,
    "text_hashes": text_hashes,
}

ORACLES = {
    "api_records": """
        SELECT c_custkey, concat('N', c_nationkey) AS iso2, c_mktsegment AS iso3, c_name AS country_name,
               CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') THEN concat('Official ', c_name) END AS official_name,
               n_name AS capital, r_name AS region, n_name AS subregion, c_custkey * 1000 AS population,
               abs(c_acctbal) AS area_km2, 'EUR|USD' AS currencies,
               CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') THEN concat('L', c_nationkey) ELSE '' END AS languages,
               'api' AS source_type
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    """,
    "page_protocol": """
        SELECT count(*) AS pages, 2 * count(*) AS objects, 0::BIGINT AS problems, 1::BIGINT AS terminal_pages,
               2 * min(c_custkey) AS first_offset, 2 * max(c_custkey) + 2 AS end_offset, 0::BIGINT AS gaps, true AS complete
        FROM customer
    """,
    "broken_pages": """
        SELECT event_id, event_type, CASE event_type
            WHEN 'click' THEN 'empty page announces more' WHEN 'view' THEN 'more is not a boolean'
            WHEN 'error' THEN 'interface reported failure' WHEN 'purchase' THEN 'objects or meta is missing'
            ELSE 'not JSON' END AS problem
        FROM events
    """,
    "html_table_rows": """
        SELECT page_id, 0::INTEGER AS position, 'World' AS country_name, 8232000000::BIGINT AS population_scraped,
               'total row' AS rejected FROM pages
        UNION ALL SELECT page_id, 1, url, length(html) * 1000 + page_id, NULL FROM pages
        UNION ALL SELECT page_id, 3, 'Unknown', NULL, 'not a number' FROM pages
    """,
    "sink_csv": """
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
               CASE WHEN o_orderstatus <> 'P' THEN concat('a "quoted", ', o_orderpriority) END AS note,
               CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate
        FROM orders
    """,
    "sink_json": "SELECT c_custkey, c_name, c_acctbal, CAST(NULL AS VARCHAR) AS absent FROM customer",
    "json_array": "SELECT c_custkey, c_name, c_acctbal, CAST(NULL AS VARCHAR) AS absent FROM customer",
    "newest_output": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "sink_parquet": """
        SELECT l_orderkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate, l_tax FROM lineitem
    """,
    "manifest_verify": """
        SELECT 'customer' AS source, segment, CASE segment WHEN 'BUILDING' THEN 'changed' WHEN 'HOUSEHOLD' THEN 'removed' ELSE 'unchanged' END AS state
        FROM (SELECT DISTINCT c_mktsegment AS segment FROM customer) UNION ALL SELECT 'customer', 'added', 'added'
    """,
    "raw_copies": """
        SELECT o_orderpriority AS priority, concat_ws('|', o_orderkey, o_custkey, o_orderstatus, '\u00e9' || chr(13)) || chr(10) AS chunk FROM orders
    """,
    "text_hashes": """
        SELECT segment, strlen(t)::BIGINT AS bytes, sha256(t) AS sha256 FROM (
            SELECT c_mktsegment AS segment, string_agg(c_name || ' \u00e9' || chr(10), '' ORDER BY c_custkey) AS t FROM customer GROUP BY c_mktsegment
        )
    """,
    "file_lineage": " UNION ALL ".join(
        f"SELECT '{n}' AS source, '{n}.parquet' AS file FROM {n} HAVING count(*) > 0" for n in NAMES
    ),
}

import hashlib
import json
import os
import random
import time
import tracemalloc

import pytest
from pyspark.sql import functions as F

from goldspine import schema as S
from goldspine.operators.dedupe import keep_last
from goldspine.sinks.documents import lineage, slug, write_document, write_table
from goldspine.sinks.staging import staging_path
from goldspine.sources import files, html, pages, tables
from goldspine.sources.manifest import ManifestError, manifest_outputs, newest_output, run_sources, run_tally
from tests.countries import API_OBJECT, HTML


def test_schema_helpers(spark):
    df = spark.createDataFrame([("1", "x")], "b string, extra string")
    assert S.align(df, "a string, b int", {"a": F.lit("d")}).first() == ("d", 1)
    with pytest.raises(S.MissingColumns, match=r"\['a', 'c'\]"):
        S.require_columns(df, ["c", "b", "a"])
    described = S.describe(df, {"b": "a code"})
    assert described.schema["b"].metadata == {"comment": "a code"}


def test_csv_keeps_input_order_when_split(spark, tmp_path):
    draw = random.Random(1)
    rows = [(str(draw.randrange(50)), str(i), draw.choice(["", 'q "x", y', "é"])) for i in range(4000)]
    path = tmp_path / "in.csv"
    import csv

    with path.open("w", newline="", encoding="utf-8") as stream:
        writer = csv.writer(stream)
        writer.writerow(["note", "extra", "iso", "n"])
        writer.writerows((note, "e", key, n) for key, n, note in rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = files.read_csv(spark, str(path), "iso string, n string, note string", ordinal=True)
        assert df.rdd.getNumPartitions() > 5
        found = {r.iso: (r.n, r.note) for r in keep_last(df, ["iso"], [files.ORDINAL]).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == {key: (n, note or None) for key, n, note in rows}
    with pytest.raises(S.MissingColumns):
        files.read_csv(spark, str(path), "absent string")


def test_json_arrays_and_lines(spark, tmp_path):
    records = [{"iso3": "FRA", "n": 1}, {"iso3": "DEU"}]
    (tmp_path / "a.json").write_text(json.dumps(records, indent=2))
    (tmp_path / "l.json").write_text("\n".join(json.dumps(r) for r in records))
    for path, lines in (("a.json", False), ("l.json", True)):
        df = files.read_json(spark, str(tmp_path / path), "iso3 string, n int, z string", lines=lines, ordinal=True)
        assert [tuple(r) for r in df.orderBy(files.ORDINAL).select("iso3", "n", "z").collect()] == [("FRA", 1, None), ("DEU", None, None)]


def test_newest_file(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for i, name in enumerate(["a_1.csv", "a_2.csv", "b_3.txt"]):
        (folder / name).write_text(name)
        os.utime(folder / name, (1_700_000_000 + i * 100,) * 2)
    assert files.newest_file(spark, str(folder), ["a_*.csv"]).endswith("a_2.csv")
    assert files.newest_file(spark, str(folder), ["a_*.csv", "*.txt"]).endswith("b_3.txt")
    assert files.newest_file(spark, str(folder), ["z*"], required=False) is None
    assert files.newest_file(spark, str(tmp_path / "none"), ["z*"], required=False) is None
    with pytest.raises(files.NoSuchFile):
        files.newest_file(spark, str(folder), ["z*"])


def _awkward_files(folder):
    contents = {
        "a.bin": b"x" * 10, "b.bin": os.urandom(3_000_000), "c.txt": b"\n", "d.txt": b"\n\n", "e.txt": b"one\r\ntwo", "f.txt": b"one\ntwo\n",
        "g.txt": b"\xef\xbb\xbfmarked", "h.txt": b"\xef\xbb\xbfmarked\n", "i.txt": b"\xef\xbb\xbf\xef\xbb\xbf\n\n", "j.bin": b"\0" * 100_000, "k.csv.gz": os.urandom(5000),
        "l.txt": b"long " * 20_000 + b"\n" + b"last",
    }
    (folder / "empty.bin").write_bytes(b"")
    for name, data in contents.items():
        (folder / name).write_bytes(data)
    return contents


@pytest.mark.parametrize("split", ["128m", "100k"])
def test_fingerprints_and_copies_of_any_bytes(spark, tmp_path, split):
    """Files split over tasks, without an end of the last line, with a mark at the beginning, without any line."""
    contents = _awkward_files(tmp_path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        found = {os.path.basename(r.path): (r.length, r.sha256) for r in files.fingerprints(spark, str(tmp_path)).collect()}
        copies = spark.read.parquet(files.write_raw(spark, str(tmp_path), staging_path(spark, "raw")))
        rows = files.stored_bytes(copies).orderBy("path", "block", "position").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == {n: (len(d), hashlib.sha256(d).hexdigest()) for n, d in contents.items()}
    kept = {}
    for r in rows:
        name = os.path.basename(r.path)
        kept[name] = kept.get(name, b"") + bytes(r.chunk)
    assert kept == contents
    if split == "100k":
        assert len({r.block for r in rows if r.path.endswith("b.bin")}) > 10


def test_combined_fingerprint_follows_the_bytes(spark, tmp_path):
    for name in ("a.bin", "b.bin"):
        (tmp_path / name).write_bytes(b"x" * 10)
    whole = files.fingerprints(spark, str(tmp_path)).agg(*files.combined_fingerprint(str(tmp_path))).first()
    (tmp_path / "a.bin").write_bytes(b"y" * 10)
    changed = files.fingerprints(spark, str(tmp_path)).agg(*files.combined_fingerprint(str(tmp_path))).first()
    assert whole["bytes"] == changed["bytes"] and whole["sha256"] != changed["sha256"] and len(whole["sha256"]) == 64


def test_equal_files_of_two_folders_do_not_cancel(spark, tmp_path):
    hashes = set()
    for text in ("hello", "HELLO"):
        root = tmp_path / text
        for part in ("p=1", "p=2"):
            (root / part).mkdir(parents=True)
            (root / part / "part-0").write_text(text)
        hashes.add(files.fingerprints(spark, str(root)).agg(*files.combined_fingerprint(str(root))).first().sha256)
    assert len(hashes) == 2 and "0" * 64 not in hashes


def test_lineage(spark, tmp_path):
    path = write_table(spark.range(5).coalesce(1), str(tmp_path / "t"))
    assert [r.source for r in lineage({"t": spark.read.parquet(path)}).collect()] == ["t"]


def test_relational_scan_and_bound_sql(spark):
    df = spark.createDataFrame([("B", True), ("A", True), ("C", False)], "iso2 string, active boolean")
    assert [r.iso2 for r in tables.scan_active(df, "iso2").collect()] == ["A", "B"]
    assert tables.run_sql(spark, "SELECT count(*) AS n FROM {df} WHERE active = :on", {"on": True}, df=df).first().n == 2
    with pytest.raises(ValueError):
        tables.run_sql(spark, "  ")


def page(objects, more, **extra):
    return json.dumps({"data": {"objects": objects, "meta": {"more": more}}, **extra})


def captured(spark, payloads, step=1):
    return spark.createDataFrame([(i * step, p) for i, p in enumerate(payloads)], "page_offset bigint, payload string")


def test_api_record(spark):
    record = pages.extract_records(captured(spark, [page([API_OBJECT, "stray", 3], False)]), "payload", "page_offset", "http://x").collect()
    assert len(record) == 1
    row = record[0].asDict()
    assert (row["iso2"], row["iso3"], row["country_name"], row["official_name"], row["capital"]) == ("ES", "ESP", "Spain", "Kingdom of Spain", "Madrid")
    assert (row["region"], row["subregion"], row["population"], row["area_km2"]) == ("Europe", "Southern Europe", 47500000, 505000.0)
    assert (row["currencies"], row["languages"], row["source_type"], row["source_url"]) == (["EUR"], ["Catalan", "Spanish"], "api", "http://x")
    assert list(row) == S.schema(S.API_RECORD).fieldNames()


def test_api_pages_are_concatenated(spark):
    two = captured(spark, [page([{"codes": {"alpha_2": "FR"}}], True), page([{"codes": {"alpha_2": "DE"}}], False)])
    assert sorted(r.iso2 for r in pages.extract_records(two, "payload", "page_offset").collect()) == ["DE", "FR"]


@pytest.mark.parametrize(
    ("payload", "problem"),
    [
        ("<html>", "not JSON"), ("[1]", "payload is not an object"), ('{"success": false}', "interface reported failure"),
        ('{"data": 1}', "data is missing"), ('{"data": {"objects": [1]}}', "objects or meta is missing"),
        ('{"data": {"objects": {}, "meta": {}}}', "objects or meta is missing"),
        ('{"data": {"objects": [1], "meta": {"more": "no"}}}', "more is not a boolean"),
        ('{"data": {"objects": [1], "meta": {}}}', "more is not a boolean"),
        ('{"data": {"objects": [], "meta": {"more": true}}}', "empty page announces more"),
    ],
)
def test_page_faults(spark, payload, problem):
    frame = captured(spark, [payload])
    assert pages.parse_pages(frame, "payload").first().problem == problem
    with pytest.raises(pages.PageError):
        pages.extract_records(frame, "payload", "page_offset")


def test_capture_must_be_complete(spark):
    one, last = page([1], True), page([1], False)

    def complete(payloads, offsets):
        frame = spark.createDataFrame(list(zip(offsets, payloads)), "o bigint, payload string")
        return pages.protocol_summary(pages.parse_pages(frame, "payload"), "o").first().complete

    assert complete([one, one, last], [0, 1, 2])
    assert not complete([one, last], [0, 2])
    assert not complete([one, one], [0, 1])
    assert not complete([last, last], [0, 1])
    assert not complete([one, last], [1, 2])
    assert not complete([one, one, last], [0, 0, 1])
    assert not complete([], [])
    with pytest.raises(pages.PageError, match="no record"):
        pages.extract_records(captured(spark, [last]), "payload", "page_offset")
    for size in (0, 101):
        with pytest.raises(ValueError):
            pages.check_page_size(size)


def test_html_rows(spark):
    df = spark.createDataFrame([(1, HTML), (2, "<p>no table</p>"), (3, None), (4, "<table class='wikitable'><tr><th>Country</th></tr></table>")], "id int, html string")
    cleaned = html.clean_rows(html.raw_rows(df, "html", "id"), "id").orderBy("position").collect()
    assert [(r.id, r.country_name, r.population_scraped, r.rejected) for r in cleaned] == [
        (1, "World", 8100000000, "total row"), (1, "Brazil", 214000000, None), (1, "Spain", 47500000, None),
    ]
    records = html.scraped_records(df.withColumn("url", F.lit("u")), "html", "url")
    assert records.columns == S.schema(S.SCRAPED_RECORD).fieldNames()
    assert html.require_records(records).count() == 2
    with pytest.raises(html.TableNotFound):
        html.require_records(records.limit(0))


GOOD = '<table class="wikitable"><tr><th>Country</th><th>Population</th></tr><tr><td>{}</td><td>1</td></tr></table>'


@pytest.mark.parametrize(
    ("text", "table_id", "expected"),
    [
        ('<table id="p"><tr><td>COUNTRY</td><td>x population y</td></tr><tr><td>A</td><td>1</td></tr></table>'
         '<table class="wikitable"><tr><th>Location<th></tr></table>', "p", [(0, "A", "1")]),
        ('<table id="p"><tr><td>Area</td></tr></table><table class="a wikitable b"><tr><th>Population</th><th>Country</th></tr>'
         "<tr><td>5</td><th>B <b>c</b> &amp; d<!-- no --><script>x</script></th></tr><tr><td>short</td></tr></table>", "p",
         [(0, "B c & d", "5")]),
        ('<table class="wikitables"><tr><th>Country</th><th>Population</th></tr><tr><td>A</td><td>1</td></tr></table>', None, []),
        ('<table class="wikitable"><tbody><tr><th>Country</th><th>Population</th></tr><tr><td>A<br>b<table><tr><td>in</td></tr></table>'
         "</td><td>1</td></tr></tbody></table>", None, [(0, "A b in", "1")]),
        ("", None, []),
        # The table with the id wins although one of the class ends before it; if it does not fit, that one stays.
        (GOOD.format("A") + GOOD.format("B").replace("<table", '<table id="p"'), "p", [(0, "B", "1")]),
        (GOOD.format("A") + '<table id="p"><tr><td>x</td></tr></table>', "p", [(0, "A", "1")]),
        # A table inside the first row of one that does not fit, and one that fits around it.
        ('<table class="wikitable"><tr>' + GOOD.format("in") + "</tr></table>", None, [(0, "in", "1")]),
        ('<table class="wikitable"><tr><td>Country</td><td>Population' + GOOD.format("in") + "</td></tr><tr><td>C</td><td>3</td></tr></table>",
         None, [(0, "Country", "Population"), (1, "in", "1"), (2, "C", "3")]),
        # Empty elements, a cell inside a cell, an end tag of nothing, a table that is never closed.
        ('<table class="wikitable"/><table class="wikitable"><tr/></table>' + GOOD.format("D</b>e<td>f</td>")[:-8], None, [(0, "De f", "1")]),
    ],
)
def test_table_choice(text, table_id, expected):
    assert list(html.table_rows(text, table_id)) == expected


def test_large_page_in_bounded_memory():
    """50 MB of paragraphs and of tables that do not fit, then one that does."""
    other = '<table class="wikitable"><tr><th>Area</th></tr>' + "<tr><td>1</td><td>2</td></tr>" * 5000 + "</table>"
    page = "<p>" + ("<b>word</b> " + "x" * 500 + "<br>") * 96_000 + other * 5 + GOOD.format("A")
    assert len(page) > 50_000_000
    tracemalloc.start()
    assert html.table_rows(page) == [(0, "A", "1")]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8_000_000


def test_html_rows_of_many_pages(spark):
    """More rows than leave a task at once; kept columns may be named as one likes."""
    rows = "<table class='wikitable'><tr><th>Country</th><th>Population</th></tr>" + "<tr><td>A</td><td>1</td></tr>" * 300 + "</table>"
    df = spark.range(0, 200, 1, 2).select(F.col("id").alias("a.b"), F.lit(rows).alias("_page"), F.array("id").alias("list"))
    found = html.raw_rows(df.where("id % 2 = 0").withColumnRenamed("list", "name"), "_page", "a.b", "name")
    assert found.columns == ["a.b", "name", "position", "name_cell", "value_cell"]
    by_page = found.groupBy("`a.b`", "name").agg(F.count("*").alias("n"), F.max("position").alias("last")).collect()
    assert len(by_page) == 100 and {(r.n, r.last, r.name[0] == r["a.b"]) for r in by_page} == {(300, 299, True)}
    assert html.raw_rows(df.limit(0), "_page", "a.b").count() == 0


def build_run(spark, root, names=("file", "api", "scraping", "database", "bigdata"), fail=(), go_on=False):
    def job(name):
        def run():
            if name in fail:
                raise RuntimeError("timeout")
            output = f"data/raw/{name}/{name}_selected"
            write_table(spark.range(3), f"{root}/{output}", "json")
            return output, 3

        return run

    return run_sources(spark, {n: job(n) for n in names}, root, continue_on_error=go_on)


NAMES = ["file", "api", "scraping", "database", "bigdata"]


def edit(path, change):
    target = next(p for p in path.iterdir() if p.name.startswith("part-"))
    manifest = json.loads(target.read_text())
    change(manifest)
    (path / f".{target.name}.crc").unlink()
    target.write_text(json.dumps(manifest, indent=1))


def test_manifest_selects_and_verifies(spark, tmp_path):
    root = str(tmp_path)
    path = build_run(spark, root)
    write_table(spark.range(9), f"{root}/data/raw/api/api_newer", "json")
    found = manifest_outputs(spark, path, root, "data/raw", NAMES)
    assert found == {n: f"{root}/data/raw/{n}/{n}_selected" for n in NAMES}
    assert newest_output(spark, f"{root}/data/raw/api", "api_*").endswith("api_newer")
    assert {r.status: r.sources for r in run_tally(spark, path).collect()} == {"success": 5}
    from pathlib import Path

    document = Path(path)
    edit(document, lambda m: m["results"][0].update(sha256="wrong"))
    with pytest.raises(ManifestError, match="sha256 differs"):
        manifest_outputs(spark, path, root, "data/raw", NAMES)


@pytest.mark.parametrize(
    ("change", "message"),
    [
        (lambda m: m["errors"].append({"source": "api", "error": "x"}), "incomplete"),
        (lambda m: m["results"].pop(), "absent or repeated"),
        (lambda m: m["results"].append(m["results"][0]), "absent or repeated"),
        (lambda m: m["results"][0].update(status="failed"), "did not succeed"),
        (lambda m: m["results"][0].update(output_file="data/raw/api/../../x"), "outside"),
        (lambda m: m["results"][0].update(rows=0), "empty"),
        (lambda m: m["results"][0].update(bytes=1), "bytes differ"),
        (lambda m: m["results"][0].update(output_file="data/raw/file/absent"), "missing"),
    ],
)
def test_manifest_faults(spark, tmp_path, change, message):
    from pathlib import Path

    path = build_run(spark, str(tmp_path))
    edit(Path(path), change)
    with pytest.raises(ManifestError, match=message):
        manifest_outputs(spark, path, str(tmp_path), "data/raw", NAMES)


def test_run_stops_or_continues(spark, tmp_path):
    stopped = build_run(spark, f"{tmp_path}/a", fail=("api",))
    assert {r.status: r.sources for r in run_tally(spark, stopped).collect()} == {"success": 1, "error": 1}
    went_on = build_run(spark, f"{tmp_path}/b", fail=("api",), go_on=True)
    assert {r.status: r.sources for r in run_tally(spark, went_on).collect()} == {"success": 4, "error": 1}
    with pytest.raises(ManifestError, match="incomplete"):
        manifest_outputs(spark, went_on, f"{tmp_path}/b", "data/raw", NAMES)


def test_documents(spark, tmp_path):
    from goldspine.sources.manifest import read_manifest

    path = write_document(spark, {"é": [1, None]}, str(tmp_path / "d.json"))
    assert read_manifest(spark, path) == {"é": [1, None]}
    assert time.strptime(slug(), "%Y%m%dT%H%M%SZ")


@pytest.mark.parametrize("query", ["api_records", "page_protocol"])
def test_pages_of_one_row_group_are_parsed_by_all_tasks(spark, tmp_path, monkeypatch, query):
    from goldspine.suite import ingest

    ids = spark.range(1, 401).repartition(1)
    ids.select(
        F.col("id").alias("c_custkey"), F.concat(F.lit("C"), "id").alias("c_name"), (F.col("id") % 3).cast("int").alias("c_nationkey"),
        (F.col("id") - 200.5).alias("c_acctbal"), F.lit("BUILDING").alias("c_mktsegment"),
    ).write.parquet(f"{tmp_path}/customer.parquet")
    spark.sql("SELECT id AS n_nationkey, 'N' AS n_name, 0L AS n_regionkey FROM range(3)").write.parquet(f"{tmp_path}/nation.parquet")
    spark.sql("SELECT 0L AS r_regionkey, 'R' AS r_name").write.parquet(f"{tmp_path}/region.parquet")
    parsed = []
    monkeypatch.setattr(ingest, "parse_pages", lambda rows, *args, do=ingest.parse_pages: parsed.append(rows) or do(rows, *args))
    found = ingest.QUERIES[query](spark, str(tmp_path))
    if query == "api_records":
        assert sorted((r.c_custkey, r.country_name, r.population) for r in found.collect()) == [(i, f"C{i}", i * 1000) for i in range(1, 401)]
    else:
        assert (found.first().pages, found.first().objects, found.first().problems) == (400, 800, 0)
    dealt = parsed[0].groupBy(F.spark_partition_id()).count().collect()
    assert len(dealt) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(r["count"] for r in dealt) <= 200

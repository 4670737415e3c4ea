import re
import unicodedata
from decimal import Decimal

from pyspark.sql import functions as F, types as T

from goldspine.functions import variants as V
from goldspine.functions.collections import serialize
from goldspine.functions.numbers import frame_ratio, grouped_integer, to_double, to_integer
from goldspine.functions.provenance import contributing, contributor_count, survivor
from goldspine.functions.text import (
    apply_aliases, clean_code, contains_ignoring_case, drop_footnotes, is_blank, is_code, normalize_name,
    python_normalize, truncate, upper_letters,
)

TEXT = T.StringType()


def column(spark, values, expression, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}").repartition(4)
    found = {r.i: r.r for r in rows.select("i", expression(F.col("v")).alias("r")).collect()}
    return [found[i] for i in range(len(values))]


def expected_name(text):
    if text is None:
        return None
    marks_dropped = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    plain = re.sub(r"\[[^]]*\]", "", marks_dropped.casefold())
    return " ".join(re.findall("[a-z0-9]+", plain)) or None


def test_names_fold_like_unicode_for_every_character(spark):
    points = [chr(p) for p in (*range(1, 0x20000), *range(0x2F700, 0x2FB00), *range(0xE0000, 0xE0200)) if not 0xD800 <= p < 0xE000]
    values = [f"x{c}Y" for c in points] + [None, "", "   ", "Straße ﬁn Ⅻ [a] ½", "[x", "a]b[c]d"]
    assert column(spark, values, normalize_name) == [expected_name(v) for v in values]
    assert [python_normalize(v) for v in values[-6:]] == [expected_name(v) for v in values[-6:]]


def test_name_cases_and_aliases(spark):
    aliased = column(spark, ["  Türkiye [1] ", "turkey", None, "東京"], lambda c: apply_aliases(normalize_name(c), {"turkiye": "turkey"}))
    assert aliased == ["turkey", "turkey", None, None]
    assert column(spark, ["Côte-d'Ivoire", "Øre"], normalize_name) == ["cote d ivoire", "re"]
    assert column(spark, ["a", "b"], lambda c: apply_aliases(c, {"a": "b", "b": "c"})) == ["b", "c"]
    assert column(spark, ["a"], lambda c: apply_aliases(c, {})) == ["a"]


def test_codes(spark):
    assert column(spark, ["fr", "F-R", "FRA", "1", None, "é f r"], lambda c: clean_code(c, 2)) == ["FR", "FR", None, None, None, "FR"]
    assert column(spark, ["FR", "Fr", "FRA", "FR\n", None], lambda c: is_code(c, 2)) == [True, False, False, False, False]
    assert column(spark, ["fr", "f1", ""], upper_letters) == ["FR", None, None]


def test_text_helpers(spark):
    assert column(spark, [" a [1] ", " b[x]\n", "[c]"], drop_footnotes) == ["a", "b", ""]
    assert column(spark, [" \t ", "x", None], is_blank) == [True, False, True]
    assert column(spark, ["50% off", "500 off", "A_B", "AxB"], lambda c: contains_ignoring_case(c, "0%")) == [True, False, False, False]
    assert column(spark, ["A_B", "AxB"], lambda c: contains_ignoring_case(c, "a_b")) == [True, False]
    assert column(spark, ["abcdef"], lambda c: truncate(c, 3)) == ["abc"]


def test_lenient_numbers(spark):
    texts = ["1 234,5", "1,234.5", "1e3", "-7", "abc", "", None, "1d", "NaN", " 12\t"]
    assert column(spark, texts, lambda c: to_double(c, TEXT)) == [1234.5, None, 1000.0, -7.0, None, None, None, None, None, 12.0]
    assert column(spark, ["1 234", "a-12", "1-2", "", None, "9" * 30], lambda c: to_integer(c, TEXT)) == [1234, -12, None, None, None, None]
    assert column(spark, [68000000.0, 1.5, float("nan"), None], lambda c: to_integer(c, T.DoubleType()), "double") == [68000000, 2, None, None]
    shown = ["68,551,653 [a]", "1 234 567", "٣٤", "12.5", "-3", "", None]
    assert column(spark, shown, grouped_integer) == [68551653, 1234567, 34, None, None, None, None]


def test_ratios_round_half_up_and_guard_zero(spark):
    df = spark.createDataFrame([(68551653, 551695.0), (1, 8.0), (1, 0.0), (None, 2.0), (39, 0.44)], "p bigint, a double")
    found = [r.d for r in df.select(frame_ratio(df, "p", "a").alias("d")).collect()]
    assert found == [Decimal("124.26"), Decimal("0.13"), None, None, Decimal("88.64")]


def test_collections(spark):
    assert column(spark, [[" b", "a ", None, "", "a"], [], [" "], None], lambda c: serialize(c, T.ArrayType(TEXT)), "array<string>") == ["a|b", None, None, None]
    assert column(spark, [{"z": 1, "y": 2}, {}], lambda c: serialize(c, T.MapType(TEXT, T.IntegerType())), "map<string,int>") == ["y|z", None]
    assert column(spark, [" s ", " "], lambda c: serialize(c, TEXT)) == ["s", None]


def test_variant_paths(spark):
    docs = [
        '{"a":{"b":"x"},"c":"y","area":{"kilometers":5},"l":[{"code":"Z"},{"code":" "},"A",3,{"code":"Z"}]}',
        '{"a":{"b":""},"c":{"d":1},"area":7.5,"l":{"k2":1,"k1":2}}',
        '{"a":"scalar","area":"1 234,5","l":"text"}',
        "[1]",
    ]
    first = column(spark, docs, lambda c: V.first_text(F.parse_json(c), [("a", "b"), ("c",)]))
    assert first == ["x", None, None, None]
    assert column(spark, docs, lambda c: V.double(V.measure(V.at(F.parse_json(c), ("area",)), "kilometers"))) == [5.0, 7.5, 1234.5, None]
    assert column(spark, docs, lambda c: V.labels(V.at(F.parse_json(c), ("l",)), "code")) == [["A", "Z"], ["k1", "k2"], [], []]
    capitals = ['{"capital":"P"}', '{"capital":["P","Q"]}', '{"capitals":[{"name":"P"}]}', '{"capital":{"name":"P"}}', '{"capital":[],"capitals":["P"]}', '{"capital":[""]}']
    paths = [("capital", "name"), ("capital",), ("capitals",)]
    assert column(spark, capitals, lambda c: V.first_item_name(F.parse_json(c), paths)) == ["P", "P", "P", "P", "P", ""]
    assert column(spark, ['{"p":"68 000"}', '{"p":68000.0}', '{"p":null}'], lambda c: V.integer(V.at(F.parse_json(c), ("p",)))) == [68000, 68000, None]


def test_survivorship_and_provenance(spark):
    df = spark.createDataFrame([(None, "", "z"), ("x", "y", None), (None, None, None)], "v__a string, v__b string, v__c string")
    names = ["v__a", "v__missing", "v__b", "v__c"]
    seen = {n: F.col(f"v__{n}").isNotNull() for n in "abc"}
    rows = df.select(survivor(names, df.columns, "string").alias("v"), contributing(seen).alias("s"), contributor_count(seen).alias("n"), survivor(["v__q"], df.columns, "string").alias("q")).collect()
    assert [tuple(r) for r in rows] == [("", "b|c", 2, None), ("x", "a|b", 2, None), (None, "", 0, None)]

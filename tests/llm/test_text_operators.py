"""Operators on texts against plain versions, over awkward rows."""

import hashlib

import pytest
from pyspark.sql import functions as F

from goldspine.llm import jaccard, lines, repeats, rules, winnow
from tests.llm import cases

TEXTS = cases.corpus()
# Null ids rank first; the plain versions see them as the least long.
WITH_NULL = [*TEXTS, (None, "null id " + TEXTS[14][1])]
PLAIN = [(-(1 << 63) if i is None else i, t) for i, t in WITH_NULL]
ITEMS = [
    (1, " ".join(TEXTS[14][1].split()[5:30])), (2, "w1 w2"), (3, None), (4, ""), (5, "no such words here at all, none of them, not one"),
    (6, "ONE"), (10, " ".join(TEXTS[14][1].split()[20:45])), (None, "w3"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return cases.frame(spark, WITH_NULL)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], cases.SCHEMA)


def plain_id(i):
    return -(1 << 63) if i is None else i


def test_repeats(docs, nothing):
    found = repeats.summary(docs).collect()
    assert len(found) == len(WITH_NULL)
    expected = cases.removed(PLAIN)
    assert {plain_id(r.doc_id): tuple(r)[1:] for r in found} == expected
    assert sum(v[1] for v in expected.values()) > 2000
    assert repeats.summary(nothing).count() == 0


def test_repeats_of_a_common_gram_are_sent_one_by_one(docs, monkeypatch):
    monkeypatch.setattr(repeats, "MEET", 0)
    found = repeats.summary(docs.where("doc_id is not null")).collect()
    assert {r.doc_id: tuple(r)[1:] for r in found} == cases.removed(TEXTS)


def test_repeated_ranges(docs):
    texts = {plain_id(i): (t or "").encode() for i, t in WITH_NULL}
    for r in repeats.remove_repeats(docs).where("size(spans) > 0").collect():
        data, at = texts[r._id], 0
        kept = b""
        for s in r.spans:
            kept += data[at : s.s]
            at = s.e
        assert kept + data[at:] == r.kept


def test_rules(docs, nothing):
    found = rules.summary(docs).collect()
    assert len(found) == len(WITH_NULL)
    texts = dict(WITH_NULL)
    for r in found:
        expected = cases.quality_counts(texts[r.doc_id])
        assert {k: r[k] for k in expected} == expected
        assert not (r.base_failed and r.kept)
    assert rules.summary(nothing).count() == 0


def test_a_rule_table_is_a_parameter(docs):
    table = (rules.Rule("words", 5, 50), rules.Rule("stop_ratio", None, 0.0))
    found = {r.doc_id: r.failed_rules for r in rules.summary(docs, table).collect()}
    assert found[2003] == "words" and found[2011] == "words,stop_ratio"


def test_filtered_keeps_whole_rows(docs):
    kept = rules.filtered(docs)
    assert kept.columns == docs.columns
    wanted = {r.doc_id for r in rules.summary(docs).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == wanted


def test_jaccard(docs, nothing):
    found = jaccard.summary(docs).collect()
    assert len(found) == len(WITH_NULL)
    got = {plain_id(r.doc_id): (r.n_shingles, plain_id(r.component_id)) for r in found}
    assert got == cases.components(PLAIN)
    assert jaccard.summary(nothing).count() == 0


def test_jaccard_of_a_chain_and_of_many_copies(spark):
    draw = cases.random.Random(2)
    base = cases.sentence(draw, 120, 5000).split()
    texts = []
    for i in range(150):  # each differs from the base in two places: some pairs link, some do not
        w = list(base)
        for _ in range(2):
            w[draw.randrange(len(w))] = f"e{draw.randrange(10**6)}"
        texts.append((i, " ".join(w)))
    texts += [(500 + i, " ".join(base)) for i in range(40)]
    texts += [(700 + i, cases.sentence(draw, 40, 5000) + " " + " ".join(base[:60])) for i in range(40)]
    found = jaccard.summary(cases.frame(spark, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == cases.components(texts)


def test_jaccard_of_texts_that_share_an_id(spark):
    """Each text has its own set: links of every one of them are found, and none between them by their id."""
    draw = cases.random.Random(9)
    long = [cases.sentence(draw, 60 + 9 * k, 5000) for k in range(6)]
    near = [" ".join([*t.split()[:-1], "changed"]) for t in long]
    texts = [(1 if k % 2 else None, t) for k, t in enumerate(long)] + [(10 + k, t) for k, t in enumerate(near)]
    found = jaccard.near_duplicates(cases.frame(spark, texts)).collect()
    by_key = {}
    for r in found:
        by_key.setdefault(r.component, []).append((plain_id(None if r._id == jaccard.NO_ID else r._id), r.n))
    expected = [[(plain_id(1 if k % 2 else None), 56 + 9 * k), (10 + k, 56 + 9 * k)] for k in range(6)]
    assert sorted(map(sorted, by_key.values())) == sorted(expected)


def test_jaccard_pairs_in_slices(spark, monkeypatch):
    """What meets in a bucket does not grow with a list: links that only the last pass can find, over many slices."""
    draw = cases.random.Random(4)
    base = cases.sentence(draw, 120, 5000).split()
    texts = []
    for i in range(160):
        w = list(base)
        for _ in range(2):
            w[draw.randrange(len(w))] = f"e{draw.randrange(10**6)}"
        texts.append((i, " ".join(w)))
    monkeypatch.setattr(jaccard, "SLICE_ROWS", 16)
    monkeypatch.setattr(jaccard, "ROUNDS", 0)
    found = jaccard.summary(cases.frame(spark, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == cases.components(texts)

    # One list of one large component and a few nodes outside it.
    rows = [(7, k, 0 if k < 900 else k, 50, 0) for k in range(1000)]
    labelled = spark.createDataFrame(rows, "token long, node long, comp long, n int, at int")
    sliced = jaccard._sliced(labelled, 4).collect()
    sizes = cases.defaultdict(int)
    for r in sliced:
        sizes[r.token] += 1
    assert max(sizes.values()) <= 5 * 16 and len(sizes) == -(-1000 // 16) * -(-100 // 16)
    met = set()
    for t in sizes:
        lists = [r.node for r in sliced if r.token == t and r.role & 1]
        met |= {(r.node, x) for r in sliced if r.token == t and r.role & 2 for x in lists}
    assert met == {(a, b) for a in range(900, 1000) for b in range(1000)}


def test_bitmaps_never_exclude_a_pair():
    import numpy as np

    draw = np.random.default_rng(1)
    for n in (1, 7, 64, 65, 500, 3000):
        a = np.unique(draw.integers(0, 1 << 64, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: int(n * 0.92) or 1], draw.integers(0, 1 << 64, max(1, n // 50), dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            maps = [np.frombuffer(jaccard.bitmap(x), np.uint64) for x in (a, b)]
            assert jaccard._bitmaps_allow(maps, np.array([len(a), len(b)]), np.array([0]), np.array([1])).all()


def test_lines(docs, nothing):
    found = lines.dedup_lines(docs).collect()
    assert len(found) == len(WITH_NULL)
    expected = cases.line_dedup(PLAIN)
    assert {plain_id(r.doc_id): (r._n_lines, r._n_dropped, r.text) for r in found} == expected
    assert {plain_id(r.doc_id): r.kept_sha256 for r in lines.summary(docs).collect()} == {
        i: hashlib.sha256(v[2].encode()).hexdigest() for i, v in expected.items()
    }
    assert {(r.doc_id, r.n_words) for r in found} == {(r.doc_id, r.n_words) for r in docs.collect()}
    assert lines.summary(nothing).count() == 0


def test_lines_of_three_documents(spark):
    shared = "a line that is long enough"
    docs = cases.frame(spark, [(1, shared), (2, shared + "\n" + "twice is not enough"), (3, "twice is not enough\n" + shared)])
    found = {r.doc_id: r.text for r in lines.dedup_lines(docs, min_documents=3).collect()}
    assert found == {1: shared, 2: "twice is not enough", 3: "twice is not enough"}


def test_winnow(docs, items, nothing):
    expected = cases.contamination(PLAIN, ITEMS)
    found = winnow.decontaminate(docs, items).collect()
    assert len(found) == len(WITH_NULL)
    # A null item is met, but has no name.
    named = {i: (n, h, [x for x in met if x != "None"]) for i, (n, h, met) in expected.items()}
    assert {r._id: (r.n_words, r.n_hit, r["items"]) for r in found} == named
    assert winnow.summary(nothing, items).count() == 0
    assert winnow.summary(docs, items.limit(0)).where("contaminated").count() == 0


def test_winnow_finds_every_shared_span(spark):
    draw = cases.random.Random(9)
    item = cases.sentence(draw, 30, 10**6)
    w = item.split()
    texts = [(k, cases.sentence(draw, 7, 10**6) + " " + " ".join(w[k : k + 10]) + " " + cases.sentence(draw, 5, 10**6)) for k in range(21)]
    texts.append((99, " ".join(w[:9])))
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = {r.doc_id: r.n_hit for r in winnow.summary(cases.frame(spark, texts), items).collect()}
    assert found == {**{k: 10 for k in range(21)}, 99: 0}


def test_long_alternating_words_are_told_apart(spark):
    """A word of letters in Thue-Morse order and its complement meet in every sum modulo 2**64."""
    order = [bin(k).count("1") % 2 for k in range(4096)]
    for parts in (("a", "b"), ("abcdefgh", "hgfedcba")):
        one, other = ("".join(parts[k ^ flip] for k in order) for flip in (0, 1))
        assert one != other and len(one) == len(other)
        texts = [(1, f"x {one} y z u v"), (2, f"x {other} y z u v"), (3, f"x {one} y z u v")]
        found = {r.doc_id: r.component_id for r in jaccard.summary(cases.frame(spark, texts)).collect()}
        assert found == {1: 1, 2: 2, 3: 1}
        items = spark.createDataFrame([(7, one)], "item_id long, text string")
        assert {r.doc_id: r.n_hit for r in winnow.summary(cases.frame(spark, texts), items).collect()} == {1: 1, 2: 0, 3: 1}


def test_fingerprints_are_thinned_and_extended(spark):
    """A long shared passage meets in few fingerprints, and all of its words are found."""
    draw = cases.random.Random(11)
    passage = cases.sentence(draw, 200, 10**6)
    docs = cases.frame(spark, [(1, cases.sentence(draw, 50) + " " + passage + " " + cases.sentence(draw, 50)), (2, passage[:40]), (3, "w " * 30)])
    items = spark.createDataFrame([(1, "before it " + passage + " and after"), (2, "w w w w w w w w w w w"), (3, None)], "item_id long, text string")
    _, spans, _ = winnow.find_spans(docs, items)
    met = spans.where("_id = 1").select("s", "e").distinct().collect()
    assert 20 < len(met) < 110 and min(r.s for r in met) == 50 and max(r.e for r in met) == 250
    assert {r.doc_id: (r.n_hit, r.n_items) for r in winnow.summary(docs, items).collect()} == {1: (200, 1), 2: (0, 0), 3: (30, 1)}


def test_clashing_and_dotted_names(spark):
    rows = [(1, "A line of words\nother words here", 5, 6), (2, "a line of words", None, 7)]
    docs = spark.createDataFrame(rows, "`d.id` long, `the.text` string, _n_lines int, _n_dropped int")
    got = lines.dedup_lines(docs, "d.id", "the.text")
    assert sorted(got.columns) == sorted(docs.columns)
    assert sorted(map(tuple, got.select("`d.id`", "`the.text`", "_n_lines", "_n_dropped").collect())) == [(1, rows[0][1], 2, 0), (2, "", 1, 1)]
    kept = lines.dedup_lines(docs, "d.id", "the.text", counts=False)
    assert kept.columns == docs.columns and {tuple(r)[2:] for r in kept.collect()} == {(5, 6), (None, 7)}
    assert jaccard.near_duplicates(docs, "d.id", "the.text").count() == 2
    assert repeats.remove_repeats(docs, "d.id", "the.text").count() == 2

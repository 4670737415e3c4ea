"""The pipeline's stages against plain versions, each on what its predecessor kept."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from goldspine.llm import rules
from goldspine.sinks.staging import stage
from tests.llm import cases


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    draw = cases.random.Random(6)
    prose = lambda n: " ".join(draw.choice(["the", "of", "and", "to"]) if k % 3 == 0 else f"word{draw.randrange(5000)}" for k in range(n))
    texts, line, secret = [], "one line of words that many pages hold", prose(30)
    for i in range(60):
        text = prose(70 + i)
        if i % 6 == 1:
            text = text + "\n" + line
        if i % 6 == 2:
            text = text + " " + secret + " " + prose(10)
        if i % 6 == 3:
            text = " ".join(w + "###" for w in text.split())
        if i % 6 == 4 and i > 6:
            w = texts[-10][1].split(" ")
            w[5] = "changed"
            text = " ".join(w)
        texts.append((i, text))
    texts += [(100, None), (101, ""), (102, "too short"), texts[0], texts[7]]
    frame = cases.frame(spark, texts, ["a", "b", None])
    frame.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, secret)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def _texts(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "mixture"]
    quality, line_dedup, near_dedup, decontamination, mixture = (f for _, f in corpus_pipeline.STAGES)

    kept = stage(quality(spark, docs, folder), "kept")
    assert kept.columns == docs.columns
    verdict = {r.doc_id for r in rules.summary(docs).where("kept").collect()}
    assert sorted(_texts(kept)) == sorted(t for t in _texts(docs) if t[0] in verdict) and 40 < len(verdict) < 60

    lined = stage(line_dedup(spark, kept, folder), "lined")
    expected = cases.line_dedup(_texts(kept))
    assert lined.schema == kept.schema
    assert {(r.doc_id, r.text, r.n_chars) for r in lined.collect()} == {(i, v[2], len(v[2])) for i, v in expected.items()}

    near = stage(near_dedup(spark, lined, folder), "near")
    groups = cases.components(_texts(lined))
    assert near.columns == docs.columns
    assert sorted(r.doc_id for r in near.collect()) == sorted({c for n, c in groups.values() if n} | {i for i, (n, _) in groups.items() if not n})
    assert near.count() < lined.count()

    clean = stage(decontamination(spark, near, folder), "clean")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    hits = cases.contamination(_texts(near), items)
    assert sorted(_texts(clean)) == sorted(t for t in _texts(near) if not hits[t[0]][1]) and clean.count() < near.count()

    mixed = stage(mixture(spark, clean, folder), "mixed")
    sizes, taken = {}, {}
    for r in clean.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(cases.words(r.text))
    for r in mixed.collect():
        taken[r.source] = taken.get(r.source, 0) + len(cases.words(r.text))
    for source, target in cases.targets(sizes).items():
        assert target - 150 < taken.get(source, 0) <= target + 1
    assert mixed.groupBy("doc_id", "mix_copy").count().where("count > 1").count() == 0

    # The stages one after the other are the run.
    whole = corpus_pipeline.run(spark, folder)
    assert sorted((r.doc_id, r.mix_copy) for r in whole.collect()) == sorted((r.doc_id, r.mix_copy) for r in mixed.collect())


def test_empty_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, folder)
        assert docs.count() == 0


def test_rows_without_words_are_no_duplicates(spark, folder):
    docs = cases.frame(spark, [(1, None), (2, ""), (3, " "), (None, None), (4, "a b"), (5, "A b")])
    assert sorted(r.doc_id or -1 for r in corpus_pipeline.near_dedup(spark, docs, folder).collect()) == [-1, 1, 2, 3, 4]
    assert corpus_pipeline.near_dedup(spark, docs.withColumn("text", F.lit(None).cast("string")), folder).count() == 6


def test_near_dedup_of_shared_and_null_ids(spark, tmp_path):
    """Rows link by their texts: documents without an id, or of one id, stay if their texts differ."""
    draw = cases.random.Random(8)
    long = [cases.sentence(draw, 90, 5000) for _ in range(8)]
    near = [" ".join([*t.split()[:-1], "changed"]) for t in long]
    texts = [(None, t) for t in long[:4]] + [(5, long[4]), (5, long[5]), (6, long[6]), (7, long[7])]
    texts += [(20, near[0]), (None, near[1]), (21, near[5]), (5, near[6]), (None, long[3])]
    kept = corpus_pipeline.near_dedup(spark, cases.frame(spark, texts), str(tmp_path)).collect()
    groups = [next(k for k, pair in enumerate(zip(long, near)) if r.text in pair) for r in kept]
    assert sorted(groups) == list(range(8))
    assert {(r.doc_id, k) for r, k in zip(kept, groups)} == {(None, 0), (None, 1), (None, 2), (None, 3), (5, 4), (5, 5), (5, 6), (7, 7)}

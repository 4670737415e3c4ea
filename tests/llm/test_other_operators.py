"""Mixing, classifiers, archives and chats."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from goldspine.llm import chat, linear, mixing, sketch, toxicity, warc, weak_quality
from goldspine.sinks.staging import staging_path
from goldspine.suite.tables import read
from tests.llm import cases

SF = "/root/testdata/sf0.01"


def test_targets(spark):
    draw = cases.random.Random(4)
    for sizes in (
        {f"s{k}": draw.randrange(1, 10**draw.randrange(1, 6)) for k in range(17)}, {"a": 5, None: 100, "B": 0, "é": 7}, {"a": 10}, {"a": 0, "b": 0}
    ):
        given = spark.createDataFrame(list(sizes.items()), "_source string, source_size long")
        got = {r._source: r.target for r in mixing.targets(given).collect()}
        expected = cases.targets(sizes)
        assert got == pytest.approx(expected)


def test_mix_meets_targets(spark):
    texts = [(i, cases.sentence(cases.random.Random(i), i % 90)) for i in range(400)] + [(900, None), (901, "")]
    docs = cases.frame(spark, texts, ["a", "a", "a", None, "b", "c", "D"])
    found = mixing.summary(docs).collect()
    assert len(found) == len(texts)
    source = {r.doc_id: r.source for r in docs.collect()}
    sizes, taken, target = {}, {}, {}
    for r in found:
        s = source[r.doc_id]
        assert r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        sizes[s], taken[s], target[s] = sizes.get(s, 0) + r.size, taken.get(s, 0) + r.taken, r.target
        assert r.source_size == sum(len((t or "").split()) for i, t in texts if source[i] == s)
    assert target == pytest.approx(cases.targets(sizes))
    for s, t in target.items():
        # The rest is less than any document left of the block that holds the cut.
        assert 0 <= t - taken[s] <= 40
    assert sorted(mixing.summary(docs.repartition(7)).collect()) == sorted(found)
    assert mixing.summary(docs.limit(0)).count() == 0


def test_mix_fills_past_a_long_document(spark):
    """One document of a tenth of its source's words, in many sources: nothing that is left fits what is left of a target."""
    draw = cases.random.Random(12)
    rows = []
    for s in range(24):
        for k in range(60):
            n = draw.randrange(10, 40) if k else 160
            rows.append((100 * s + k, " ".join(["w"] * n), f"s{s:02}"))
    rows += rows[:3]  # repeated rows are taken alike
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    documents, mixed = mixing.mix(docs, block_docs=4, depth=2)
    found, later = documents.collect(), 0
    for s in {r._source for r in found}:
        ours = [r for r in found if r._source == s]
        whole = int(ours[0].target // ours[0].source_size)
        gap = ours[0].target - sum(r.size * r.copies for r in ours)
        rest = [r.size for r in ours if r.copies == whole]
        assert {r.copies for r in ours} <= {whole, whole + 1}
        assert 0 <= gap and (not rest or gap < min(rest))
        later += any(r._last != r._rank for r in ours)
    assert later
    copies = {(r._id, r._fp): r.copies for r in found}
    placed = mixed.groupBy("_id", "_fp").agg(F.countDistinct("_copy").alias("n"), F.count(F.when(F.col("_shard").isNull(), 1)).alias("none")).collect()
    assert {(r._id, r._fp): r.n for r in placed} == {k: n for k, n in copies.items() if n} and not any(r.none for r in placed)


def test_a_row_of_two_sources_is_two_documents(spark):
    """The same id and text in sources that take different shares: each takes its own."""
    shared = [(i, cases.sentence(cases.random.Random(i), 30 + i % 40)) for i in range(120)]
    rows = [(i, t, s) for i, t in shared for s in ("a", "b")] + [(1000 + i, cases.sentence(cases.random.Random(i), 50), "b") for i in range(500)]
    rows += [(i, t, None) for i, t in shared[:10]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    sizes = {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in ("a", "b", None)}
    aims, taken = cases.targets(sizes), dict.fromkeys(sizes, 0)
    found = mixing.summary(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        source = next(s for s, t in aims.items() if t == pytest.approx(r.target))
        assert r.taken <= 2 * r.size and r.source_size == sizes[source]
        taken[source] += r.taken
    for s, t in aims.items():
        assert 0 <= t - taken[s] <= 100


def test_shards_get_all_blocks_once(spark):
    docs = cases.frame(spark, [(i, "a b c d e") for i in range(1000)], ["a", "a", "b"])
    documents, mixed = mixing.mix(docs, block_docs=4, depth=3)
    rows = mixed.collect()
    assert len({(r._id, r._copy) for r in rows}) == len(rows) == sum(r.copies for r in documents.collect())
    per_shard = [sum(r._shard == s for r in rows) for s in range(8)]
    assert min(per_shard) > 0.7 * max(per_shard)


def test_hypergeometric_draws(spark):
    cases_ = [(50, 20, 10), (1000, 300, 500), (7, 7, 3), (9, 0, 4), (5, 2, 5), (100000, 50000, 50000), (0, 0, 0)]
    for n, k, d in cases_:
        u = spark.range(3000).select(((F.col("id") + 0.5) / 3000).alias("u"))
        got = u.select(mixing._hypergeometric(F.lit(n), F.lit(k), F.lit(d), F.col("u")).alias("x"))
        low, high, mean, deviation = got.agg(F.min("x"), F.max("x"), F.avg("x"), F.stddev("x")).first()
        assert max(0, d + k - n) <= low and high <= min(k, d)
        expected = d * k / n if n else 0
        variance = d * (k / n) * (1 - k / n) * (n - d) / max(1, n - 1) if n else 0
        assert mean == pytest.approx(expected, abs=0.02 + 0.02 * variance**0.5)
        assert deviation == pytest.approx(variance**0.5, abs=0.02 + 0.03 * variance**0.5)


@pytest.fixture(scope="module")
def labelled(spark):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    return docs, labels


def test_toxicity_on_held_out_labels(spark, labelled):
    """A tenth of the labels is held out; of few toxic rows most are found, of others few are taken for it."""
    docs, labels = labelled
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    chain = toxicity.fit_chain(docs, labels.where(~held_out))
    found = toxicity.score(chain, docs).join(labels.where(held_out).withColumnRenamed("doc_id", "_id"), "_id")
    hit, clean, n_toxic, n_clean = found.agg(
        F.sum((F.col("is_toxic") & (F.col("toxic") == 1)).cast("int")), F.sum((F.col("is_toxic") & (F.col("toxic") == 0)).cast("int")),
        F.sum(F.col("toxic")), F.sum(1 - F.col("toxic")),
    ).first()
    assert hit >= 0.4 * n_toxic and clean <= 0.1 * n_clean


def test_toxicity_of_awkward_rows(spark):
    docs = cases.frame(spark, [(1, "you vile thing"), (2, "a good day"), (3, None), (4, ""), (None, "vile"), (1, "you vile thing")] + [
        (10 + i, ("vile " if i % 2 else "fine ") + cases.sentence(cases.random.Random(i), 12)) for i in range(60)
    ])
    marks = spark.createDataFrame([(10 + i, 1, i % 2) for i in range(60)] + [(3, None, 1), (None, 1, 1), (10, 1, 0), (777, 1, 1)], "doc_id long, quality int, toxic int")
    found = toxicity.summary(docs, marks).collect()
    assert len(found) == 66
    got = {r.doc_id: r.toxic for r in found}
    assert got[1] and not got[2] and not got[3] and not got[4] and all(got[10 + i] == bool(i % 2) for i in range(60))
    # No labels, labels of one kind, no documents.
    assert toxicity.summary(docs, marks.limit(0)).where("toxic").count() == 0
    assert toxicity.summary(docs, marks.where("toxic = 0")).count() == 66
    assert toxicity.summary(docs.limit(0), marks).count() == 0


def plain_logistic(rows, beside, y, penalty=1e-2, rounds=60):
    """The model of ``linear.fit``, word by word: weights of places, of columns beside them, and the bias."""
    n, share = len(rows), sum(y) / len(y)
    seen = {p for row in rows for p in row}
    with_, positive = {p: sum(p in r for r in rows) for p in seen}, {p: sum(t for r, t in zip(rows, y) if p in r) for p in seen}
    ratio = {
        p: math.log((positive[p] + 2 * share) / (with_[p] - positive[p] + 2 * (1 - share)) * (1 - share) / share) if with_[p] >= 2 else 0.0
        for p in seen
    }
    names = sorted(seen)
    matrix = np.array([[ratio[p] if p in r else 0.0 for p in names] + list(b) + [1.0] for r, b in zip(rows, beside)])
    v = np.ones(matrix.shape[1])
    for _ in range(8):
        v = matrix.T @ (matrix @ (v / np.linalg.norm(v))) / n
    step = 1 / (0.3 * np.linalg.norm(v) + penalty)
    free = np.append(np.full(matrix.shape[1] - 1, penalty), 0.0)
    w = np.zeros(matrix.shape[1])
    clipped = min(max(share, 1e-4), 1 - 1e-4)
    w[-1] = math.log(clipped / (1 - clipped))
    ahead, t = w, 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(matrix @ ahead)))
        after = ahead - step * (matrix.T @ (p - np.array(y)) / n + free * ahead)
        later = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = after + (t - 1) / later * (after - w), after, later
    weight = {p: w[k] * ratio[p] for k, p in enumerate(names)}

    def predict(row, columns):
        z = sum(weight.get(p, 0.0) for p in row) + sum(a * b for a, b in zip(columns, w[len(names) : -1])) + w[-1]
        return 1 / (1 + math.exp(-z))

    return predict


def test_chain_equals_a_plain_one():
    """Out-of-fold columns, thresholds and probabilities, against loops over rows and words."""
    draw = random.Random(11)
    rows = [sorted(draw.sample(range(40), draw.randint(0, 12))) for _ in range(90)]
    y = {"a": [float(bool({1, 2} & set(r))) for r in rows], "b": [float(3 in r or draw.random() < 0.1) for r in rows], "none": [0.0] * 90}
    folds = [draw.randrange(toxicity.FOLDS) for _ in rows]
    places, begins = linear.stacked(rows)
    chain = toxicity.learn(places, begins, {k: np.array(v) for k, v in y.items()}, np.array(folds))
    got = chain.predict(places, begins)

    before, final = [[] for _ in rows], [[] for _ in rows]
    for k, (name, t) in enumerate(y.items()):
        if name == "none":
            assert np.all(got[:, k] < 1e-6)
            continue
        whole = plain_logistic(rows, before, t)
        out = [0.0] * len(rows)
        for fold in range(toxicity.FOLDS):
            inside = [i for i in range(len(rows)) if folds[i] != fold]
            model = plain_logistic([rows[i] for i in inside], [before[i] for i in inside], [t[i] for i in inside])
            for i in range(len(rows)):
                if folds[i] == fold:
                    out[i] = model(rows[i], before[i])
        final = [f + [whole(r, f)] for r, f in zip(rows, final)]
        assert got[:, k] == pytest.approx([f[-1] for f in final], abs=1e-5)
        threshold = chain.models[name].threshold
        f1 = lambda cut: 2 * sum(o >= cut and u for o, u in zip(out, t)) / (sum(o >= cut for o in out) + sum(t))
        assert f1(threshold) == pytest.approx(max(f1(o) for o in out))
        before = [b + [o] for b, o in zip(before, out)]


def test_toxicity_of_two_texts_of_a_labelled_id(spark):
    """Of a labelled id's texts the same one is learnt from, however rows lie."""
    rows = [(i % 40, f"word{i} " + ("vile" if i % 2 else "fine")) for i in range(80)]
    marks = spark.createDataFrame([(i, 1, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    results = [
        sorted(toxicity.summary(cases.frame(spark, some).repartition(n), marks).collect()) for some, n in ((rows, 1), (rows[::-1], 5))
    ]
    assert results[0] == results[1]


def test_estimation_equals_a_plain_one():
    """Expectation-maximisation over single rows of votes, heuristic by heuristic."""
    draw = random.Random(5)
    rows = ["".join(draw.choice("01-") if draw.random() < 0.5 else "1" for _ in weak_quality.LABELLERS) for _ in range(300)]
    posterior = [(r.count("1") + 1) / (r.count("0") + r.count("1") + 2) for r in rows]
    for _ in range(100):
        prior = sum(posterior) / len(rows)
        given = {}
        for good in (True, False):
            mass = [p if good else 1 - p for p in posterior]
            for k in range(len(rows[0])):
                sums = {v: 0.5 + sum(m for m, r in zip(mass, rows) if r[k] == v) for v in "01-"}
                for v in "01-":
                    given[good, k, v] = sums[v] / sum(sums.values())
        odds = [
            math.log((1 - prior) / prior) + sum(math.log(given[False, k, v] / given[True, k, v]) for k, v in enumerate(r) if v != "-") for r in rows
        ]
        posterior = [1 / (1 + math.exp(o)) for o in odds]
    got, accuracy = weak_quality.estimate({r: rows.count(r) for r in rows})
    assert [got[r] for r in rows] == pytest.approx(posterior, abs=1e-9)
    for k, name in enumerate(weak_quality.LABELLERS):
        voting = given[True, k, "1"] / (given[True, k, "0"] + given[True, k, "1"])
        assert accuracy[name]["good"] == pytest.approx(voting)


def test_scores_equal_a_plain_model(spark):
    """Every row's posterior and score, from measures of one text at a time and a plain linear model."""
    docs = cases.frame(spark, [(i, t) for i, (_, t) in enumerate(cases.corpus(n=40))])
    got = {r._id: r for r in weak_quality.score(docs).collect()}
    texts = {r.doc_id: (r.text or "") for r in docs.collect()}
    votes, places = {}, {}
    for i, text in texts.items():
        data = text.encode()
        n, measures, found, _ = weak_quality.measure(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        votes[i], places[i] = weak_quality.votes(n, measures)[0], found.tolist()
    every = list(votes.values())
    posterior, _ = weak_quality.estimate({v: every.count(v) for v in every})
    ids = sorted(texts)
    predict = plain_logistic([places[i] for i in ids], [[] for _ in ids], [posterior[votes[i]] for i in ids])
    assert got.keys() == texts.keys()
    for i in ids:
        assert (got[i].votes, got[i].posterior) == (votes[i], pytest.approx(posterior[votes[i]]))
        assert got[i].score == pytest.approx(predict(places[i], []), abs=1e-4)


def test_counters_add_up_over_levels(spark, monkeypatch):
    """A tree of two rows a task gives the same sums as one task, and none of no rows."""
    monkeypatch.setattr(sketch, "_FAN", 2)

    def count(batches):
        counts = np.zeros(1 << 10, np.int64)
        for batch in batches:
            for i in batch.column("id").to_pylist():
                counts[i % 7] += 1
        yield sketch.partial(counts)

    sums = sketch.total(spark.range(0, 1000, 1, 11).mapInArrow(count, sketch.PARTIAL), lambda c: c)
    assert sums[:7].tolist() == [len(range(k, 1000, 7)) for k in range(7)] and sums[7:].sum() == 0
    assert len(sketch.total(spark.createDataFrame([], sketch.PARTIAL), lambda c: c)) == 0


def test_quality_against_labels(labelled):
    docs, labels = labelled
    found = weak_quality.summary(docs).join(labels, "doc_id")
    right, n = found.agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int")), F.count("*")).first()
    assert n > 300 and right > 0.95


def test_quality_of_awkward_rows(spark):
    docs = cases.frame(spark, cases.corpus(n=20) + [(None, "x y")])
    assert weak_quality.summary(docs).count() == docs.count()
    assert weak_quality.summary(docs.limit(0)).count() == 0


def test_accuracies_are_found():
    """Heuristics of known accuracy vote at random; estimation tells them apart."""
    draw = np.random.default_rng(3)
    good = draw.random(20000) < 0.7
    accuracy = [0.95, 0.9, 0.8, 0.6, 0.9, 0.75, 0.85, 0.7]
    patterns = {}
    for g in good:
        p = "".join("-" if draw.random() < 0.3 else ("1" if g == (draw.random() < a) else "0") for a in accuracy)
        patterns[p] = patterns.get(p, 0) + 1
    _, found = weak_quality.estimate(patterns)
    for a, f in zip(accuracy, found.values()):
        assert f["good"] == pytest.approx(a, abs=0.03) and f["bad"] == pytest.approx(a, abs=0.03)


PAGES = [
    (5, "http://a/", "<p>" + "x" * 200), (3, "http://b/\r\nX: y", "<p>" + "x" * 200), (9, None, "<p>" + "x" * 200), (1, "http://c/", None), (2, "", ""),
    (4, "u", "short"), (6, "u", "short"), (7, "u", "é" * 50), (8, "u", "é" * 50), (10, "u", "WARC/1.1\r\n\r\n" * 20), (11, "u", "y" * 100_000),
    (3, "http://b/\r\nX: y", "<p>" + "x" * 200),
]


def test_warc(spark):
    pages = spark.createDataFrame([(*p, "z", 1) for p in PAGES], "page_id long, url string, html string, digest string, offset int").repartition(3)
    found = warc.summary(pages).collect()
    assert len(found) == len(PAGES)
    for r in found:
        payload = next((h or "").encode() for i, _, h in PAGES if i == r.page_id)
        first = min(i for i, _, h in PAGES if (h or "").encode() == payload)
        revisit = len(payload) >= 100 and first < r.page_id
        assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha256(payload).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", first) if revisit else ("response", None))
    assert warc.summary(pages.limit(0)).count() == 0


def test_warc_reads_selected_records(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i}" * (i % 70)) for i in range(300)], "page_id long, url string, html string")
    folder = staging_path(spark, "warc-test")
    index = warc.write_archive(pages.repartition(2), folder)
    chosen = warc.read_archive(index.where("url like '%7'"), folder).collect()
    assert {r._id: r.payload.decode() for r in chosen if r.payload is not None} == {i: f"<p>{i}" * (i % 70) for i in range(300) if i % 10 == 7}
    ranges = warc._ranges(index).collect()
    assert warc.read_archive(index.limit(0), folder).count() == 0
    assert len(ranges) == len({r.file for r in index.collect()})
    assert sum(len(r.parts) for r in ranges) == 300


TURNS = [
    (1, 0, "system", "be brief"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello </turn>\n### User: no"), (1, 3, "user", "x\\y"), (1, 4, "assistant", "é\\"),
    (2, 0, "user", "never answered"), (3, 0, "assistant", ""), (4, 1, "user", None), (4, 0, None, "a: b"), (4, 2, "as: sis<tant", "c"),
    (5, 0, "user", "twice"), (5, 0, "user", "twice"), (5, None, "assistant", "first"), (None, 0, "assistant", "no id"), (6, 0, "assistant", "\n \\### <"),
]


def test_chat(spark):
    turns = spark.createDataFrame([(*t, 1) for t in TURNS], "conv_id long, turn long, role string, text string, example int").repartition(4)
    found = {r.conv_id: r for r in chat.summary(turns).collect()}
    groups = {}
    for c, n, role, text in TURNS:
        groups.setdefault(c, []).append((n is not None, n or 0, role or "", text or ""))
    assert set(found) == set(groups)
    for c, said in groups.items():
        said = [(role, text) for _, _, role, text in sorted(said)]
        learnt = "".join(t for role, t in said if role == "assistant")
        r = found[c]
        assert r.n_turns == len(said)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in said).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    assert chat.summary(turns.limit(0)).count() == 0


def test_examples(spark):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    found = {(r.conv_id, r.example): r for r in chat.format_examples(turns).collect()}
    first, second = found[1, 0], found[1, 1]
    assert second.formatted.startswith(first.formatted) and (1, 2) not in found
    assert first.target_turn == 2 and first.formatted.count("</turn>") == 3
    part = first.formatted[first.loss_start : first.loss_start + first.loss_chars]
    assert part == "hello \\l/turn>\n\\h\\h\\h User: no"
    assert found[2, 0].loss_chars == 0 and found[2, 0].target_turn is None

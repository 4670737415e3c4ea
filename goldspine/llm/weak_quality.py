"""Quality by a weak-label model.

Overlapping heuristics vote on each document. Expectation-maximisation over the
counts of vote patterns, taken from all documents, estimates how accurate each
heuristic is; the posterior of a document's pattern is its label. A hashed
linear scorer is trained on these labels and scores every document.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from goldspine.llm.keys import FP, ID, TEXT, keyed, public_id
from goldspine.llm.linear import MAX_TRAINING_ROWS, Model, distinct_places, fit, stacked
from goldspine.llm.rules import STOP_WORDS
from goldspine.llm.tokens import AS_WRITTEN, SPACED, U64, Spans, chunks, mix, words
from goldspine.sinks.staging import stage

#: A heuristic's measure, then where it votes bad (below, above) and where good (from, to);
#: some never vote good, since the absence of symbols, say, is no sign of quality.
LABELLERS: Mapping[str, tuple[float, float, float, float]] = {
    "symbols per word": (-1, 0.2, 2, -2),
    "double marks per word": (-1, 0.2, 2, -2),
    "stop words": (0.05, 0.7, 0.12, 0.5),
    "bytes per word": (3, 8, 4, 7),
    "distinct words": (0.25, 2, 0.4, 1),
    "same word again": (-1, 0.1, 0, 0.02),
    "repeated lines": (-1, 0.4, 2, -2),
    "capitals": (-1, 0.4, 2, -2),
}
#: A text of fewer words gets no votes.
MIN_WORDS = 10
#: Steps in which the scorer sees each measure, beside the words.
_STEPS = 10
BAD, GOOD, SILENT = "0", "1", "-"


def _per_text(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    running = np.concatenate([[0], np.cumsum(marks)])
    return running[offsets[1:]] - running[offsets[:-1]]


def _stop_hashes() -> np.ndarray:
    data = "\n".join(STOP_WORDS).encode()
    return np.unique(words(np.frombuffer(data, np.uint8), np.array([0, len(data)]), SPACED)[0][0])


def measure(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, its measures in the order of ``LABELLERS``, and its distinct places."""
    rows = len(offsets) - 1
    (folded,), begins = words(data, offsets, SPACED)
    (written,), _ = words(data, offsets, AS_WRITTEN)
    n = np.diff(begins)
    some = np.maximum(n, 1)
    blank = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    chars = _per_text(~blank, offsets)
    stops = _per_text(np.isin(folded, _stop_hashes()), begins)
    places, starts = distinct_places(written, begins)
    # Lines with a word, by their hash.
    newline = data == 0x0A
    line_starts = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(newline) + 1]))
    line_starts = line_starts[line_starts < len(data)]
    line_ends = np.append(line_starts[1:], len(data)) if len(line_starts) else line_starts
    running = np.concatenate([[0], np.cumsum(~blank)])
    full = running[line_ends] > running[line_starts]
    line_starts, line_ends = line_starts[full], line_ends[full]
    # A line ends before its newline, if it has one.
    line_ends = line_ends - (newline[line_ends - 1] if len(line_ends) else 0)
    owner = np.searchsorted(offsets, line_starts, "right") - 1
    hashes = Spans(data).hash(line_starts, line_ends) if len(line_starts) else np.zeros(0, U64)
    lines = np.bincount(owner, minlength=rows)
    distinct = np.bincount(np.unique(np.stack([owner.astype(U64), hashes]), axis=1)[0].astype(np.int64), minlength=rows) if len(owner) else lines
    again = np.zeros(len(written), bool)
    again[1:] = written[1:] == written[:-1]
    again[begins[:-1][n > 0]] = False
    pair = np.zeros(len(data), bool)
    pair[1:] = (data[1:] == 0x21) & (data[:-1] == 0x21)
    measures = np.column_stack([
        _per_text(np.isin(data, np.frombuffer(b"#*$%&|<>", np.uint8)), offsets) / some,
        _per_text(pair, offsets) / some,
        stops / some,
        chars / some,
        np.diff(starts) / some,
        _per_text(again, begins) / some,
        (lines - distinct) / np.maximum(lines, 1),
        _per_text((data >= 0x41) & (data <= 0x5A), offsets) / np.maximum(chars, 1),
    ])
    # The scorer's rows: distinct words as written, and each measure's step.
    steps = np.minimum(_STEPS, (measures * np.where(np.array(list(LABELLERS)) == "bytes per word", 1, _STEPS)).astype(np.int64))
    marked = mix((steps * len(LABELLERS) + np.arange(len(LABELLERS))).astype(U64) + U64(1 << 40))
    per_row = np.concatenate([written, marked.ravel()])
    row = np.concatenate([np.repeat(np.arange(rows), n), np.repeat(np.arange(rows), len(LABELLERS))])
    order = np.argsort(row, kind="stable")
    places, starts = distinct_places(per_row[order], np.concatenate([[0], np.cumsum(n + len(LABELLERS))]))
    return n, measures, places, starts


def votes(n: np.ndarray, measures: np.ndarray) -> list[str]:
    """One letter for each heuristic; too short a text is left to the model."""
    low, high, first, last = np.array(list(LABELLERS.values())).T
    bad = (measures < low) | (measures > high)
    good = (measures >= first) & (measures <= last) & ~bad
    letters = np.where(bad, BAD, np.where(good, GOOD, SILENT))
    letters[n < MIN_WORDS] = SILENT
    return ["".join(row) for row in letters]


def estimate(patterns: Mapping[str, int], rounds: int = 100) -> tuple[dict[str, float], dict[str, dict[str, float]]]:
    """Posterior of good for each pattern, and each heuristic's accuracy where it votes.

    Patterns are at most three to the power of the heuristics, whatever the
    corpus. Votes are taken as independent given the class; estimation begins
    at the share of good votes.
    """
    names = sorted(patterns)
    if not names:
        return {}, {}
    weight = np.array([patterns[p] for p in names], float)
    letters = np.array([[(BAD + GOOD + SILENT).index(v) for v in p] for p in names])
    good, bad = (letters == 1).sum(1), (letters == 0).sum(1)
    posterior = (good + 1) / (good + bad + 2)
    one_hot = np.eye(3)[letters]
    heard = one_hot * [1, 1, 0]  # silence says nothing
    for _ in range(rounds):
        prior = np.clip((weight * posterior).sum() / weight.sum(), 1e-6, 1 - 1e-6)
        given_good = np.einsum("p,plv->lv", weight * posterior, one_hot) + 0.5
        given_bad = np.einsum("p,plv->lv", weight * (1 - posterior), one_hot) + 0.5
        given_good /= given_good.sum(1, keepdims=True)
        given_bad /= given_bad.sum(1, keepdims=True)
        ratio = np.log((1 - prior) / prior) + np.einsum("plv,lv->p", heard, np.log(given_bad) - np.log(given_good))
        posterior = 1 / (1 + np.exp(np.clip(ratio, -50, 50)))
    voting = lambda given, k, v: float(given[k, v] / max(given[k, :2].sum(), 1e-12))
    accuracy = {name: {"good": voting(given_good, k, 1), "bad": voting(given_bad, k, 0)} for k, name in enumerate(LABELLERS)}
    return dict(zip(names, posterior.tolist())), accuracy


def _voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Votes and places of every row, in the one pass over the texts."""
    for part, data, offsets in chunks(batches, TEXT):
        n, measures, places, starts = measure(data, offsets)
        lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(places))
        yield pa.RecordBatch.from_arrays([part.column(ID), part.column(FP), pa.array(votes(n, measures), pa.string()), lists], names=[ID, FP, "votes", "places"])


def _drawn(share: float) -> Column:
    """Whether a row is of the sample, by a hash of its id and text."""
    return F.pmod(F.xxhash64(F.lit("quality sample"), ID, FP), F.lit(1 << 30)) < int(share * (1 << 30))


def _trainer(posterior: Mapping[str, float]):
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One task for the whole sample, whose size is a parameter."""
        table = pa.Table.from_batches(batches)
        order = np.lexsort((table.column(FP).to_numpy(), table.column(ID).to_numpy()))
        table = table.take(pa.array(order, pa.int64()))
        places, begins = stacked(table.column("places").to_numpy(zero_copy_only=False))
        y = np.array([posterior[v] for v in table.column("votes").to_pylist()])
        yield pa.RecordBatch.from_arrays([pa.array([cloudpickle.dumps(fit(places, begins, np.zeros((len(y), 0)), y))], pa.binary())], names=["model"])

    return train


def score(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", most: int = MAX_TRAINING_ROWS) -> DataFrame:
    """``_id, _fp, votes, posterior, score`` for every row.

    Texts are read and measured once: their votes and the places of their words
    are staged, some bytes for each distinct word, and the scorer reads those.
    It is fitted on about ``most`` documents at most, drawn by a hash of
    id and text; votes and their counts cover all. Null and empty texts, and
    texts of under ten words, get no votes: their posterior is the share of good
    documents. An empty table stays empty.
    """
    spark = docs.sparkSession
    rows = keyed(docs, id_column, text_column)
    voted = stage(rows.mapInArrow(_voted, f"{ID} long, {FP} long, votes string, places array<int>"), "votes")
    counts = {r["votes"]: r["n"] for r in voted.groupBy("votes").agg(F.count("*").alias("n")).collect()}
    posterior, _ = estimate(counts)
    sample = voted.where(_drawn(min(1.0, most / max(sum(counts.values()), 1))))
    found = sample.repartition(1).mapInArrow(_trainer(posterior), "model binary").collect() if posterior else []
    learnt: Model | None = cloudpickle.loads(found[0][0]) if found else None
    shared = spark.sparkContext.broadcast(cloudpickle.dumps((learnt, posterior)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = cloudpickle.loads(shared.value)
        for batch in batches:
            lists, given = batch.column("places"), batch.column("votes").to_pylist()
            starts = lists.offsets.to_numpy().astype(np.int64)
            places = lists.values.to_numpy()
            scores = model.predict(places, starts, np.zeros((batch.num_rows, 0)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(ID), batch.column(FP), batch.column("votes"), pa.array([known[v] for v in given], pa.float64()), pa.array(scores)],
                names=[ID, FP, "votes", "posterior", "score"],
            )

    return voted.mapInArrow(run, f"{ID} long, {FP} long, votes string, posterior double, score double")


def summary(docs: DataFrame) -> DataFrame:
    return score(docs).select(
        public_id("doc_id"), "votes", F.round("posterior", 6).alias("posterior"), F.round("score", 6).alias("score"), (F.col("score") >= 0.5).alias("kept")
    )

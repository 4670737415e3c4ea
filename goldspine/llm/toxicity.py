"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear models over hashed
words. A model also sees the probabilities of the categories before it; in
training these are out-of-fold, so it learns from predictions as good as those
it will meet.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from goldspine.llm.keys import FP, ID, TEXT, keyed, public_id
from goldspine.llm.linear import MAX_TRAINING_ROWS, Model, best_threshold, constant, distinct_places, fit, stacked, take
from goldspine.llm.tokens import ALNUM, U64, chunks, mix, words
from goldspine.sinks.staging import stage

FOLDS = 3
#: The chain over the table ``labels``: unfit as prose, then toxic, then toxic though it reads as prose.
CATEGORIES: Mapping[str, str] = {
    "unfit": "quality = 0",
    "toxic": "toxic = 1",
    "toxic_prose": "toxic = 1 and quality = 1",
}


@dataclass
class Chain:
    """What ``fit_chain`` has learnt: a model for each category, in order."""

    models: dict[str, Model]

    def predict(self, places: np.ndarray, begins: np.ndarray) -> np.ndarray:
        out = np.zeros((len(begins) - 1, 0))
        for model in self.models.values():
            out = np.column_stack([out, model.predict(places, begins, out)])
        return out


def learn(places: np.ndarray, begins: np.ndarray, targets: dict[str, np.ndarray], folds: np.ndarray) -> Chain:
    """The chain of a sample: out-of-fold probabilities feed the next category and set its threshold."""
    rows = len(begins) - 1
    before = np.zeros((rows, 0))
    models = {}
    for name, y in targets.items():
        if rows == 0 or y.min() == y.max():
            # All rows or none: nothing to learn, the share is the probability.
            model = constant(y.mean() if rows else 0.0, before.shape[1])
            held_out = np.full(rows, y.mean() if rows else 0.0)
        else:
            model = fit(places, begins, before, y)
            held_out = np.zeros(rows)
            for fold in range(FOLDS):
                inside, outside = np.flatnonzero(folds != fold), np.flatnonzero(folds == fold)
                if not len(outside) or y[inside].min(initial=1) == y[inside].max(initial=0):
                    held_out[outside] = y.mean()
                    continue
                part = fit(*take(places, begins, inside), before[inside], y[inside])
                held_out[outside] = part.predict(*take(places, begins, outside), before[outside])
            model.threshold = best_threshold(held_out, y)
        models[name] = model
        before = np.column_stack([before, held_out])
    return Chain(models)


def _sampler(names: list[str]):
    schema = pa.schema([(ID, pa.int64()), *[(f"y_{n}", pa.int32()) for n in names], ("places", pa.list_(pa.int32()))])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One task for the whole sample, whose size is a parameter."""
        table = pa.Table.from_batches(batches, schema)
        table = table.take(pa.array(np.argsort(table.column(ID).to_numpy(), kind="stable"), pa.int64()))
        places, begins = stacked(table.column("places").to_numpy(zero_copy_only=False))
        folds = mix(table.column(ID).to_numpy().view(U64)) % U64(FOLDS)
        targets = {name: table.column(f"y_{name}").to_numpy().astype(float) for name in names}
        yield pa.RecordBatch.from_arrays([pa.array([cloudpickle.dumps(learn(places, begins, targets, folds))], pa.binary())], names=["chain"])

    return train


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, data, offsets in chunks(batches, TEXT):
        (hashes,), begins = words(data, offsets, ALNUM)
        places, starts = distinct_places(hashes, begins)
        lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(places))
        names = [n for n in part.schema.names if n != TEXT]
        yield pa.RecordBatch.from_arrays([*[part.column(n) for n in names], lists], names=[*names, "places"])


def fit_chain(
    docs: DataFrame, labels: DataFrame, categories: Mapping[str, str] = CATEGORIES, id_column: str = "doc_id",
    text_column: str = "text", label_id: str = "doc_id", most: int = MAX_TRAINING_ROWS,
) -> Chain:
    """Fit the chain on labelled documents, at most about ``most`` of them, drawn by a hash of the id.

    ``categories`` names each category with the condition on ``labels`` that
    makes a row one. Rows without an id or with a null condition are no
    examples; of labels with one id the first by its marks counts, of documents
    with one id the one whose text has the least hash. A category
    that all or no labelled rows have gets its share as a constant probability,
    and without any labelled document all probabilities are about 0.
    """
    names = list(categories)
    conditions = [F.expr(c).cast("int").alias(f"y_{name}") for name, c in categories.items()]
    marks = (
        labels.select(F.col(label_id).cast("long").alias(ID), *conditions).dropna()
        .groupBy(ID).agg(F.min(F.struct(*[f"y_{n}" for n in names])).alias("y")).select(ID, "y.*")
    )
    marks = stage(marks, "labels")
    rows = marks.count()
    share = 1.0 if rows <= most else most / rows
    chosen = marks.where(F.pmod(F.xxhash64(F.lit("sample"), ID), F.lit(1 << 30)) < int(share * (1 << 30)))
    # At most some ``most`` rows of a few numbers.
    met = keyed(docs, id_column, text_column).join(F.broadcast(chosen), ID)
    first = F.min_by(F.struct(*[f"y_{n}" for n in names], TEXT), FP).alias("first")
    labelled = met.groupBy(ID).agg(first).select(ID, "first.*")
    sample = stage(labelled.mapInArrow(_places, f"{ID} long, {', '.join(f'y_{n} int' for n in names)}, places array<int>"), "sample")
    return cloudpickle.loads(sample.repartition(1).mapInArrow(_sampler(names), "chain binary").first()[0])


def score(chain: Chain, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``_id, _fp``, ``p_`` and ``is_`` of each category for every row; null and empty texts have no words."""
    names = list(chain.models)
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(chain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learnt = cloudpickle.loads(shared.value)
        for part, data, offsets in chunks(batches, TEXT):
            (hashes,), begins = words(data, offsets, ALNUM)
            found = learnt.predict(*distinct_places(hashes, begins))
            columns = [part.column(ID), part.column(FP)]
            for k, name in enumerate(names):
                columns += [pa.array(found[:, k]), pa.array(found[:, k] >= learnt.models[name].threshold)]
            yield pa.RecordBatch.from_arrays(columns, names=[ID, FP, *[f"{p}_{n}" for n in names for p in ("p", "is")]])

    schema = ", ".join(f"p_{n} double, is_{n} boolean" for n in names)
    return keyed(docs, id_column, text_column).mapInArrow(run, f"{ID} long, {FP} long, {schema}")


def summary(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(fit_chain(docs, labels), docs).select(
        public_id("doc_id"), *[F.round(f"p_{name}", 6).alias(f"p_{name}") for name in CATEGORIES], F.col("is_toxic").alias("toxic")
    )

"""Centroid clustering by scalar lookup tables.

Components are integers that repeat. Of a batch of vectors each dimension's
occurring values are found once a round, and the squared difference of each of
these to each centroid is tabulated; a distance is a sum of gathered entries.
Sums and means are exact integers, so any split of the rows gives the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from goldspine.llm.keys import ID, NO_ID, public_id
from goldspine.llm.vectors import VALUES, cells, integers, leading, unpacked
from goldspine.sinks.staging import stage

#: Rows that meet one table: it has an entry for each value that occurs among them.
BATCH = 4096


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distance of each row to each centroid."""
    out = np.zeros((len(x), len(centroids)), np.int64)
    for d in range(x.shape[1]):
        occurring, place = np.unique(x[:, d], return_inverse=True)
        table = (occurring[:, None].astype(np.int64) - centroids[None, :, d]) ** 2
        out += table[place]
    return out


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray):
    """Batches with their vectors, each one's centroid (the smaller number of equally near ones) and its distance."""
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH):
            part = batch.slice(start, BATCH)
            x = unpacked(part.column(VALUES), np.int32, centroids.shape[1])
            found = distances(x, centroids)
            nearest = found.argmin(1)
            yield part, x, nearest, found[np.arange(len(x)), nearest]


def _summing(centroids: np.ndarray):
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, dims + 1), np.int64)
        for _, x, nearest, _ in _assigned(batches, centroids):
            order = np.argsort(nearest, kind="stable")
            used, first = np.unique(nearest[order], return_index=True)
            sums[used, :dims] += np.add.reduceat(x[order].astype(np.int64), first, axis=0)
            sums[:, dims] += np.bincount(nearest, minlength=k)
        used = np.flatnonzero(sums[:, dims])
        columns = [
            pa.array(np.repeat(used, dims + 1), pa.int32()), pa.array(np.tile(np.arange(dims + 1), len(used)), pa.int32()), pa.array(sums[used].ravel())
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["cell", "field", "value"])

    return run


def _labelling(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, nearest, distance in _assigned(batches, centroids):
            yield pa.RecordBatch.from_arrays([part.column(ID), pa.array(nearest, pa.int32()), pa.array(distance)], names=[ID, "cluster", "distance"])

    return run


def cluster(
    rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", k: int = 16, rounds: int = 3, scale: int = 64, dims: int = 64, seed: str = "1:"
) -> tuple[DataFrame, np.ndarray]:
    """``_id, cluster, distance`` of every vector, staged, and the centroids.

    Vectors of another length than ``dims``, null ones and those with a null or
    non-finite component are left out. Centroids start as the ``k`` vectors whose
    ids have the smallest hashes (a null id hashes as an empty one, equal hashes
    go by components); of fewer vectors there are fewer, and none of an empty
    table. Repeated rows are as many vectors. Other columns are not looked at.

    A round reads the staged vectors once; each task sends at most ``k`` rows of
    sums for each dimension, and the driver holds as many.
    """
    vectors = integers(rows, id_column, vector_column, scale, dims, "cluster-vectors")
    name = F.concat(F.lit(seed), F.when(F.col(ID) != NO_ID, F.col(ID).cast("string")).otherwise(""))
    centroids = leading(vectors, [F.sha2(name, 256)], k, dims)
    if not len(centroids):
        return vectors.select(ID, F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    for _ in range(rounds):
        # At most k * (dims + 1) rows.
        found = cells(vectors.mapInArrow(_summing(centroids), "cell int, field int, value long"))
        sums = np.zeros((len(centroids), dims + 1), np.int64)
        for r in found:
            sums[r.cell, r.field] = r.value
        used = sums[:, dims] > 0
        centroids = centroids.copy()
        centroids[used] = sums[used, :dims] // sums[used, dims:]
    done = vectors.mapInArrow(_labelling(centroids), f"{ID} long, cluster int, distance long")
    return stage(done, "clusters"), centroids


def summary(rows: DataFrame) -> DataFrame:
    assigned, centroids = cluster(rows)
    spark = rows.sparkSession
    written = [(i, ",".join(map(str, c))) for i, c in enumerate(centroids.tolist())]
    listed = spark.createDataFrame(written, "cluster int, centroid string").select("cluster", F.sha2("centroid", 256).alias("centroid_sha256"))
    per_cluster = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = assigned.agg(F.sum("distance").alias("inertia")).first()[0]
    # A row for each of k clusters.
    beside = F.broadcast(per_cluster.join(listed, "cluster").withColumn("inertia", F.lit(whole).cast("long")))
    return assigned.join(beside, "cluster").select(
        public_id("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _oracle(k: int = 16, rounds: int = 3) -> str:
    """Every distance spelled out; a mean is rounded down by its remainder."""
    steps = [f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS c, v
  FROM kept ORDER BY c LIMIT {k}
)"""]
    for i in range(rounds + 1):
        steps.append(f""", a{i} AS MATERIALIZED (
  SELECT r, v, c, d FROM (
    SELECT r, k.v, c, list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM kept k, c{i} c
  ) QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1
)""")
        if i < rounds:
            steps.append(f""", m{i} AS MATERIALIZED (
  SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY j) AS v FROM (
    SELECT c, j, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
    FROM (SELECT c, generate_subscripts(v, 1) AS j, unnest(v) AS x FROM a{i}) GROUP BY c, j
  ) GROUP BY c
), c{i + 1} AS MATERIALIZED (SELECT c, coalesce(m.v, o.v) AS v FROM c{i} o LEFT JOIN m{i} m USING (c))""")
    steps.append(f"""
SELECT k.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(o.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept k USING (r) JOIN c{rounds} o ON o.c = a.c
""")
    return "".join(steps)


ORACLE = _oracle()

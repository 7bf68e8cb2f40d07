"""Centroid clustering over dictionaries of distinct subvectors.

A vector is cut into blocks of `WIDTH` dimensions. Vectors are written once in chunks of at most `CHUNK`: for each block
the chunk's distinct subvectors, and each vector's code among them, from which the vector is restored exactly. In a round
the distance of every distinct subvector to every centroid's block is computed once, and a vector's distance is the sum
of its codes' partial distances. All numbers are integers, so that distances, sums and centroids are exact.

Chunks stay where they are: a round sends out the centroids and gets back sums by cluster, added up per chunk and again
in the shuffle. Memory is bounded by the chunk, whatever the number of vectors or how many of them are equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.llm.common import ship, table
from beaconlake.storage import pin

DIMENSIONS = 64
CENTROIDS = 40
ROUNDS = 5
SCALE = 256
WIDTH = 2
CHUNK = 8_192
#: Components beyond this raise, as their squares could leave 64 bits.
LARGEST = 1 << 27
_SHAPE = "ids array<long>, entries binary, sizes array<int>, codes binary"


def components(embedding: Column) -> Column:
    """floor(256 * x) of each component; null if there are not 64, or one is null, infinite or not a number."""
    wide = F.transform(embedding, lambda x: F.floor(SCALE * x.cast("double")))
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    small = F.forall(embedding, lambda x: F.abs(x.cast("double")) < LARGEST / SCALE)
    checked = F.when(small, wide).otherwise(F.raise_error(F.lit(f"a component is beyond {LARGEST // SCALE}")).cast("array<bigint>"))
    return F.when((F.size(embedding) == DIMENSIONS) & finite, checked)


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per chunk: ids, the dictionaries of its blocks one after the other, their sizes, and codes by block."""
    for batch in batches:
        for at in range(0, len(batch), CHUNK):
            rows = batch.slice(at, CHUNK)
            x = rows.column("q").flatten().to_numpy().reshape(-1, DIMENSIONS)
            entries, sizes, codes = [], [], []
            for b in range(0, DIMENSIONS, WIDTH):
                distinct, code = np.unique(x[:, b : b + WIDTH], axis=0, return_inverse=True)
                entries.append(distinct.astype(np.int32)), sizes.append(len(distinct)), codes.append(code.reshape(-1).astype(np.uint16))
            yield pa.RecordBatch.from_arrays([
                pa.array([rows.column("vec_id").to_pylist()], pa.list_(pa.int64())), pa.array([np.concatenate(entries).tobytes()]),
                pa.array([sizes], pa.list_(pa.int32())), pa.array([np.stack(codes).tobytes()]),
            ], ["ids", "entries", "sizes", "codes"])


def encode(vectors: DataFrame) -> DataFrame:
    """`vectors` (vec_id, q of 64 integers) as rows of chunks."""
    return vectors.select("vec_id", "q").mapInArrow(_encoded, _SHAPE)


def _decoded(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[np.ndarray], np.ndarray]]:
    """Of each chunk the ids, dictionaries and codes, the last two by block."""
    for i in range(len(batch)):
        ids, entries, sizes, codes = (batch.column(k)[i] for k in range(4))
        distinct = np.frombuffer(entries.as_py(), np.int32).reshape(-1, WIDTH).astype(np.int64)
        yield ids.values, np.split(distinct, np.cumsum(sizes.as_py())[:-1]), np.frombuffer(codes.as_py(), np.uint16).reshape(DIMENSIONS // WIDTH, -1)


def _nearest(dictionaries: list[np.ndarray], codes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each vector, the smaller number of equals, and the squared distance."""
    total = np.zeros((codes.shape[1], len(centroids)), np.int64)
    for b, (distinct, code) in enumerate(zip(dictionaries, codes)):
        apart = distinct[:, None, :] - centroids[None, :, b * WIDTH : (b + 1) * WIDTH]
        total += (apart * apart).sum(axis=2)[code]
    cluster = total.argmin(axis=1)
    return cluster, total[np.arange(len(cluster)), cluster]


def _sums(centroids: np.ndarray) -> Callable:
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, dictionaries, codes in _decoded(batch):
                cluster, _ = _nearest(dictionaries, codes, centroids)
                x = np.concatenate([d[c] for d, c in zip(dictionaries, codes)], axis=1)
                order = np.argsort(cluster, kind="stable")
                found, starts, n = np.unique(cluster[order], return_index=True, return_counts=True)
                summed = np.add.reduceat(x[order], starts, axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(n), pa.array(summed.tolist(), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    return sums


def _assigned(centroids: np.ndarray) -> Callable:
    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, dictionaries, codes in _decoded(batch):
                cluster, distance = _nearest(dictionaries, codes, centroids)
                yield pa.RecordBatch.from_arrays([ids, pa.array(cluster, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return assigned


def moved(chunks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round; one without vectors stays."""
    sums = chunks.mapInArrow(_sums(centroids), "cluster int, n long, sums array<long>")
    per = sums.groupBy("cluster").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(DIMENSIONS)))
    out = centroids.copy()
    for row in per.collect():  # one row a centroid
        out[row.cluster] = [row[f"s{i}"] // row.n for i in range(DIMENSIONS)]
    return out


def cluster(vectors: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, seed: int = 2) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 for every vector of `vectors` that counts.

    `vectors` has vec_id and embedding. A vector counts if it has exactly 64 components, none null, infinite or not a
    number; others give no row, and a component beyond 2**19 raises. Centroids start as the vectors least by a hash of
    their id (rows of one id by their components; one without an id is never a start); if there are fewer, so are the
    centroids. Repeated rows count and come back as often as they came. No vector that can start a centroid gives an
    empty result. Other columns are ignored.
    """
    kept = vectors.select("vec_id", components(F.col("embedding")).alias("q")).where("q is not null")
    chunks = pin(encode(kept), "chunks")
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = kept.where("vec_id is not null").orderBy(name, "q").limit(centroids).collect()
    if not first:
        return kept.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    at = np.array([r.q for r in first], np.int64)
    for _ in range(rounds):
        at = moved(chunks, at)
    found = pin(chunks.mapInArrow(_assigned(at), "vec_id long, cluster int, distance long"), "clusters")
    inertia = {r.cluster: r.s for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at.tolist()]
    of = lambda values: F.element_at(F.array(*(F.lit(v) for v in values)), F.col("cluster") + 1)
    return found.select(
        "vec_id", "cluster", "distance", of([inertia.get(c, 0) for c in range(len(at))]).cast("long").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"), of(names).alias("centroid_sha256"),
    )


def op13_subvectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """All rounds written out, each over (vector, dimension) rows."""
    steps = [
        f"""kept AS MATERIALIZED (SELECT vec_id, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)""",
        f"d AS MATERIALIZED (SELECT vec_id, unnest(range({DIMENSIONS})) AS i, unnest(q) AS x FROM kept)",
        f"""c0 AS MATERIALIZED (SELECT k, unnest(range({DIMENSIONS})) AS i, unnest(q) AS x
  FROM (SELECT q, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS k FROM kept) WHERE k < {CENTROIDS})""",
    ]
    for r in range(ROUNDS + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, k, s FROM (SELECT d.vec_id, c.k, sum((d.x - c.x) * (d.x - c.x)) AS s
  FROM d JOIN c{r} c USING (i) GROUP BY d.vec_id, c.k) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY s, k) = 1)""")
        if r < ROUNDS:
            steps.append(f"""c{r + 1} AS MATERIALIZED (SELECT c.k, c.i, CAST(coalesce(n.x, c.x) AS BIGINT) AS x FROM c{r} c LEFT JOIN (
  SELECT k, i, (s - ((s % n) + n) % n) // n AS x FROM (SELECT a.k, d.i, sum(d.x) AS s, count(*) AS n FROM a{r} a JOIN d USING (vec_id) GROUP BY a.k, d.i)) n USING (k, i))""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(s AS BIGINT) AS distance, CAST(sum(s) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
  CAST(sum(s) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{ROUNDS} JOIN (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY k) USING (k)
"""


SQL = _sql()

ship(__name__)

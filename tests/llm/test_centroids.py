import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from beaconlake.llm import centroids

SHAPE = "vec_id long, embedding array<float>, label int"


def slow(rows, k, rounds):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, _ in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), q) for i, q in kept if i is not None)[:k]
    at = [q for _, q in start]
    near = lambda q: min((sum((a - b) ** 2 for a, b in zip(q, c)), j) for j, c in enumerate(at))
    for _ in range(rounds):
        members = [[] for _ in at]
        for _, q in kept:
            members[near(q)[1]].append(q)
        at = [[sum(x) // len(m) for x in zip(*m)] if m else c for m, c in zip(members, at)]
    found = [(i, near(q)[1], near(q)[0]) for i, q in kept]
    per = {}
    for _, c, d in found:
        per[c] = per.get(c, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    return sorted(((i if i is not None else -1, c, d, per[c], sum(per.values()), sha[c]) for i, c, d in found))


def told(df):
    return sorted((r.vec_id if r.vec_id is not None else -1, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


def vectors(seed, n):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 0.3) for _ in range(64)] for _ in range(5)]
    return [(i, [float(np.float32(rng.gauss(m, 0.05))) for m in rng.choice(middles)], i) for i in range(n)]


def test_equals_plain_rounds(spark, monkeypatch):
    monkeypatch.setattr(centroids, "CHUNK", 16)
    rows = vectors(1, 150)
    rows += [(1000 + i, rows[3][1], 0) for i in range(40)] + [rows[5], rows[5], (None, rows[7][1], 1), (2**60 + 1, rows[8][1], 1)]
    rows += [(2000, None, 1), (2001, [0.5] * 63, 1), (2002, [0.5] * 65, 1), (2003, [float("nan")] + [0.0] * 63, 1), (2004, [float("-inf")] + [0.0] * 63, 1), (2005, [None] + [0.0] * 63, 1), (2006, [], 1)]
    df = spark.createDataFrame(rows, SHAPE).repartition(3)
    assert told(centroids.cluster(df, 7, 3)) == slow(rows, 7, 3)


def test_ties_few_vectors_and_empty(spark):
    rows = [(i, [0.25 if j == i % 2 else 0.0 for j in range(64)], i) for i in range(6)]
    assert told(centroids.cluster(spark.createDataFrame(rows, SHAPE))) == slow(rows, 40, 5)
    empty = centroids.cluster(spark.createDataFrame(rows[:1], SHAPE).limit(0))
    assert empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and not empty.collect()
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster(spark.createDataFrame([(1, [1e30] * 64, 0)], SHAPE)).collect()


def test_clusters_of_the_given_vectors(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = told(centroids.op13_subvectors(spark, "/root/testdata/sf0.001"))
    assert got == slow(rows, 40, 5)
    database = duckdb.connect()
    database.execute("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.001/embeddings.parquet'")
    result = database.execute(centroids.SQL)
    names = [d[0] for d in result.description]
    assert sorted(tuple(r[names.index(c)] for c in ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]) for r in result.fetchall()) == got

import random
import re
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pytest

from beaconlake.llm import filter_audit

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def slow(docs, labels):
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    rows = []
    for d, t, s in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = [len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), bool(re.search(r"[#$%&*|]", t)), d is not None and t in least and d > least[t]]
        mine = [(q, x) for i, q, x in labels if i == d and d is not None]
        rows.append((s or "", {f for f, x in zip("ABCDE", fails) if x}, any(q == 1 for q, _ in mine), any(x == 1 for _, x in mine)))
    out = {}
    shapley = Counter()
    for p in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == p]
        for order in map("".join, permutations("ABCDE")):
            for i, f in enumerate(order):
                reached = [r for r in mine if not r[1] & set(order[:i])]
                gone = [r for r in reached if f in r[1]]
                shapley[p, f] += len(gone)
                out[p, order, i + 1] = [len(reached) - len(gone), len(gone), sum(f in r[1] for r in mine) - len(gone), sum(r[1] == {f} for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone)]
    return sorted((p, o, i, *v, shapley[p, o[i - 1]]) for (p, o, i), v in out.items())


def told(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def corpus(seed, n):
    rng = random.Random(seed)
    texts = [None, "", " \t\x0b", "|", "# " * 60, "AÉ " * 40, "same text", "the long one " * 30]
    for _ in range(n // 3):
        texts.append(" ".join(rng.choice(["aa", "Bb", "cé", "d$", "漢", "e"]) + str(rng.randrange(60)) for _ in range(rng.randrange(120))))
    return [(rng.choice([None, *range(n)]) if rng.random() < 0.1 else i, rng.choice(texts), rng.choice(["a", "b", "", None])) for i in range(n)]


@pytest.mark.parametrize("most_bits", [28, 6])
def test_equals_every_order_applied(spark, monkeypatch, most_bits):
    monkeypatch.setattr(filter_audit.first_ids, "__defaults__", (most_bits,))
    rows = corpus(most_bits, 200)
    rng = random.Random(5)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 220, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (9999, 1, 1)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, source string, mask int, part string")
    got = filter_audit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert got.columns == COLUMNS and told(got) == slow(rows, labels)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert not filter_audit.audit(docs, labels).collect()
    one = spark.createDataFrame([(1, None, None)], docs.schema)
    assert told(filter_audit.audit(one, labels)) == slow([(1, None, None)], [])


def test_bloom_clears_most_unique_texts_and_no_repeat(spark):
    rng = np.random.default_rng(3)
    unique, twice = rng.integers(-(2**62), 2**62, 4000), rng.integers(-(2**62), 2**62, 500)
    hashes = spark.createDataFrame([(int(h),) for h in [*unique, *twice, *twice]], "hash long")
    bits = filter_audit.counted_twice(hashes, 1 << 17)
    found = dict(hashes.select("hash", filter_audit.may_repeat(spark, bits)("hash").alias("may")).distinct().collect())
    assert all(found[int(h)] for h in twice)
    assert sum(found[int(h)] for h in unique) < 40


def test_the_given_documents_against_sql(spark):
    database = duckdb.connect()
    for name in ("documents", "labels"):
        database.execute(f"CREATE VIEW {name} AS SELECT * FROM '/root/testdata/sf0.001/{name}.parquet'")
    result = database.execute(filter_audit.SQL)
    names = [d[0] for d in result.description]
    assert told(filter_audit.op12_counting_bloom(spark, "/root/testdata/sf0.001")) == sorted(tuple(r[names.index(c)] for c in COLUMNS) for r in result.fetchall())

import random

import pytest
import xxhash

from beaconlake.llm import simhash
from beaconlake.llm.common import components

SCHEMA = "doc_id long, text string"


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps):
    """doc_id -> smallest doc_id reached, over all pairs."""
    root = {d: d for d, _ in fps}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(fps):
        for b, y in fps[:i]:
            if (x ^ y).bit_count() <= 3:
                a_, b_ = top(a), top(b)
                root[max(a_, b_)] = min(a_, b_)
    return {d: top(d) for d, _ in fps}


def test_fingerprints_equal_a_plain_count():
    texts = ["", None, "a", "A b", "a B c", "a\x0bb\x0cc\x1cd e", "Äb äB " * 40, "x " * 70000 + "y z"]
    for text in texts:
        assert simhash.fingerprint_of(text) == slow_fingerprint(text)


def test_components_against_all_pairs(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    base = [[rng.choice(words) for _ in range(rng.choice([1, 3, 30, 200]))] for _ in range(120)]
    rows = []
    for doc in base:
        for _ in range(rng.choice([1, 1, 1, 6])):
            copy = list(doc)
            if rng.random() < 0.7:
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append(" ".join(copy))
    rows += [None, "", " \n "]
    rng.shuffle(rows)
    rows = [(i * 3 + 1, x) for i, x in enumerate(rows)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    fps = [(d, slow_fingerprint(t)) for d, t in rows]
    assert {r.doc_id: int(r.fingerprint, 16) for r in got} == dict(fps)
    assert {r.doc_id: r.component_id for r in got} == slow_components(fps)


@pytest.mark.parametrize("run", [2, 5])
def test_crowded_keys_are_divided_without_losing_links(spark, monkeypatch, run):
    """Fingerprints around one centre meet under every key; a small RUN sends them all through the division."""
    rng = random.Random(run)
    fps = {0, (1 << 64) - 1}
    while len(fps) < 300:
        x = 0xF0F0_1234_5678_9ABC
        for _ in range(rng.randrange(1, 9)):
            x ^= 1 << rng.randrange(64)
        fps.add(x)
    fps = sorted(fps)
    signed = [(x - (1 << 64) if x >> 63 else x, i) for i, x in enumerate(fps)]
    monkeypatch.setattr(simhash, "RUN", 256 // run)
    edges = simhash.near_links(spark.createDataFrame(signed, "fp long, rep long"))
    got = {i: i for i in range(len(fps))} | {r.node: r.root for r in components(edges).collect()}
    assert got == slow_components(list(enumerate(fps)))


def test_long_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(1, 300)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 301)} | {i: 1000 for i in range(1000, 1050)}


def test_nulls_repeats_extra_columns_and_empty(spark):
    rows = [(5, "a b c d", "x"), (5, "a b c d", "y"), (None, "a b c d", "z"), (9, None, None), (None, "q r s t u", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted((r.doc_id or -1, r.component_id or -1) for r in simhash.near_duplicates(docs).collect())
    assert got == [(-1, -1), (-1, 5), (5, 5), (5, 5), (9, 9)]
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, -1, 5, 9]
    assert simhash.near_duplicates(docs.limit(0)).collect() == []
    assert simhash.drop_near_duplicates(docs.limit(0)).collect() == []

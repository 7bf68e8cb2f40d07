import hashlib
import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from beaconlake.llm import weighted_minhash as cws

SCHEMA = "doc_id long, text string"


def jaccard(a, b):
    x, y = (Counter(re.findall(r"[^\x20\x09-\x0D]+", t.lower())) for t in (a, b))
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def slow(rows):
    """doc_id -> (n_chars, edited text, next text)."""
    order = sorted(((d, t or "") for d, t in rows), reverse=True)
    out = {}
    for i, (d, t) in enumerate(order):
        after = order[(i + 1) % len(order)][1]
        cut = len(t) // 2
        out[d] = (len(t), t[: len(t) - cut] + after[:cut], after)
    return out


def test_edits_and_digests(spark):
    rng = random.Random(2)
    letters = "aé漢😀 \n"
    rows = [(i * i, "".join(rng.choice(letters) for _ in range(rng.randrange(40)))) for i in range(1, 80)] + [(-5, None), (0, "")]
    got = {r.doc_id: r for r in cws.fingerprints(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = slow(rows)
    assert {d: (r.n_chars, r.edited_sha256) for d, r in got.items()} == {
        d: (n, hashlib.sha256(e.encode()).hexdigest()) for d, (n, e, _) in want.items()
    }
    by_text = {}
    for d, t in rows:
        by_text.setdefault(t or "", set()).add(got[d].fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    for d, (_, edited, after) in want.items():
        if edited == dict(rows)[d]:
            assert got[d].near_edited == 1.0


def test_collision_rate_is_the_generalised_jaccard_similarity(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(60)]
    base = [rng.choice(words[: rng.randrange(2, 60)]) for _ in range(300)]
    texts = {0: " ".join(base), 1: " ".join(base[:200] + [rng.choice(words) for _ in range(100)]), 2: " ".join(words[:5] * 30 + base[:60])}
    docs = spark.createDataFrame(list(texts.items()), "id long, text string")
    many = {r.id: r.signature for r in cws.signatures(docs, ["id"], samples=200).collect()}
    for a, b in ((0, 1), (0, 2), (1, 2)):
        rate = sum(x == y for x, y in zip(many[a], many[b])) / 200
        assert abs(rate - jaccard(texts[a], texts[b])) < 0.11
    few = {r.id: r.signature for r in cws.signatures(docs, ["id"]).collect()}
    assert all(few[i] == many[i][: cws.SAMPLES] for i in texts)


def test_nulls_repeats_extra_columns_and_empty(spark):
    rows = [(3, "a b c d e f", 1), (3, "a b c d e f", 2), (3, "z y", 9), (None, "q r", 3), (2, None, 4), (1, " ", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hash int")
    got = cws.fingerprints(docs).collect()
    assert sorted((r.doc_id or -1, r.n_chars) for r in got) == [(-1, 3), (1, 1), (2, 0), (3, 3), (3, 11), (3, 11)]
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    lost = next(r for r in got if r.doc_id is None)
    assert lost.edited_sha256 == hashlib.sha256(b"q ").hexdigest() and lost.near_next == 0.0
    one = next(r for r in got if r.doc_id == 1)
    assert one.fingerprint == "" and one.near_next == 0.0
    assert cws.fingerprints(docs.limit(0)).collect() == []


def near(a, b):
    return 1.0 if not a.split() and not b.split() else jaccard(a, b)


def test_likeness_is_near_the_generalised_jaccard_similarity(spark):
    """The query's own columns, over documents whose words repeat: mean and root mean square error."""
    rng = random.Random(12)
    rows = []
    for i in range(400):  # words of their own for every four documents, as equal words have equal draws
        words = [f"{i // 4}w{k}" for k in range(120)]
        if i % 4 == 0:
            text = [rng.choice(words) for _ in range(150)]
        text = [rng.choice(words[: rng.randrange(1, 120)]) if rng.random() < 0.25 else w for w in text]
        rows.append((i * 3, " ".join(text)))
    got = {r.doc_id: r for r in cws.fingerprints(spark.createDataFrame(rows, SCHEMA), block=40).collect()}
    errors = []
    for d, (_, edited, after) in slow(rows).items():
        errors += [got[d].near_edited - near(dict(rows)[d], edited), got[d].near_next - near(dict(rows)[d], after)]
    assert abs(sum(errors) / len(errors)) < 0.015 and (sum(e * e for e in errors) / len(errors)) ** 0.5 < 0.065


def test_weights_decide_as_they_should(spark):
    """Two words against one of a weight: the heavier is sampled in proportion, in short and in long documents."""
    for others in (0, 2000):
        rows = [(i, " ".join([f"h{i}"] * 9 + [f"l{i}"] * 3 + [f"o{i}x{k}" for k in range(others)])) for i in range(40 if others else 120)]
        alone = [(1000 + i, " ".join([f"h{i}"] * 9)) for i, _ in rows]
        signed = {r.doc_id: r.signature for r in cws.signatures(spark.createDataFrame(rows + alone, SCHEMA), ["doc_id"], samples=64).collect()}
        found = [x == y for i, _ in rows for x, y in zip(signed[i], signed[1000 + i])]
        share = 9 / (12 + others)
        assert abs(sum(found) / len(found) - share) < 4 * (share * (1 - share) / len(found)) ** 0.5


def test_blocks_of_any_size_give_equal_results(spark):
    rng = random.Random(6)
    ids = [*range(-20, 40), *(2**k for k in range(7, 62, 3)), *(10**12 + 5 * k for k in range(30))]
    rows = [(d, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(30)))) for d in ids]
    rows += [(5, "zz y"), (5, "aa"), (10**12, rows[-30][1]), (None, "q r s"), (None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kinds = [sorted(map(str, cws.fingerprints(docs, samples=8, block=b).collect())) for b in (2, 16, 10**6)]
    assert kinds[0] == kinds[1] == kinds[2] and len(kinds[0]) == len(rows)


def test_single_document_follows_itself(spark):
    (row,) = cws.fingerprints(spark.createDataFrame([(7, "one two three")], SCHEMA)).collect()
    assert row.near_next == 1.0
    assert row.edited_sha256 == hashlib.sha256(b"one twoone tw").hexdigest()


def test_the_main_path_runs_no_python(spark, capsys):
    cws.op8_weighted_sampling(spark, "/root/testdata/sf0.001").explain("formatted")
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


def test_ids_follow_each_other_over_all_parts(spark):
    ids = list(range(0, 5000, 7))
    got = {r.doc_id: r.next_id for r in cws.following(spark.createDataFrame([(i,) for i in ids], "doc_id long")).collect()}
    assert got == {b: a for a, b in zip(ids, ids[1:])} | {ids[0]: ids[-1]}


def test_production_likeness_is_near_the_similarity(spark):
    """Root mean square error over pairs of similarity 0.8: 0.05 at 64 samples, 0.09 at 20."""
    pair = lambda i: (" ".join(f"p{i}w{k}" for k in range(90)), " ".join(f"p{i}w{k}" for k in range(10, 100)))
    texts = [(2 * i + j, t) for i in range(200) for j, t in enumerate(pair(i))]
    got = {r.doc_id: r.signature for r in cws.signatures(spark.createDataFrame(texts, SCHEMA), ["doc_id"]).collect()}
    likeness = [sum(x == y for x, y in zip(got[2 * i], got[2 * i + 1])) / cws.SAMPLES for i in range(200)]
    assert (sum((x - 0.8) ** 2 for x in likeness) / 200) ** 0.5 < 0.065
    assert abs(sum(likeness) / 200 - 0.8) < 0.015


def test_generators_are_compiled_and_draws_look_logarithms_up(spark, capsys):
    """A generator with a lambda copies a document's arrays per term; a draw took three logarithms by native calls."""
    docs = spark.createDataFrame([(1, "a b")], SCHEMA)
    cws.fingerprints(docs).explain("formatted")
    plan = capsys.readouterr().out
    generators = re.findall(r"\) Generate.*?\n\n", plan, re.S)
    assert generators and not any("lambdafunction" in g for g in generators)
    least = re.findall(r"\) HashAggregate.*?\n\n", plan, re.S)
    assert least and not any(re.search(r"-?LN\(LN|-LN\(\(", a) for a in least)


def test_looked_up_draws_are_gamma(spark):
    """exp(ln c) of every part of the range is the quantile of Gamma(2, 1)."""
    us = [2.0**-29, 1e-8, 1e-6, 1e-4, 3e-3, 0.0155, 0.0157, 0.02, 0.1, 0.3, 0.5, 0.8, 0.99]
    bits = spark.createDataFrame([(int(u * 2**28),) for u in us], "bits long").crossJoin(cws._tables(spark))
    for r in bits.select("bits", F.exp(cws._log_c(F.col("bits"))).alias("c")).collect():
        reached = r.c**2 / 2 - r.c**3 / 3 + r.c**4 / 8 if r.c < 1e-3 else 1 - (1 + r.c) * math.exp(-r.c)
        assert abs(reached / ((r.bits + 0.5) * 2.0**-28) - 1) < 0.001

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from beaconlake.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string"


def corpus(n=300, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["a"] * 6 + ["b", "c"])
        lang = {"a": "en", "b": "de", "c": "fr"}[source] if rng.random() < 0.9 else "en"
        text = " ".join("w" * rng.randrange(1, 9) for _ in range(rng.randrange(1, 400)))
        rows.append((i, text, lang if i % 17 else None, source if i % 11 else None))
    return rows + [(1000, None, None, None), (1001, "", "en", "a")]


def slow(rows, weights):
    """doc_id -> (posterior, rate), document by document."""
    feats, tokens = [], []
    for _, text, lang, source in rows:
        text = text or ""
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text))
        step = lambda x: math.floor(math.log2(1.0 + x))
        feats.append((source or "\0", lang or "\0", step(n), step(n / (text.count("\n") + 1)), min(20, len(text) // max(1, n))))
        tokens.append(n)
    domains = sorted(weights)
    sizes = Counter(f[0] for f in feats)
    total = sum(sizes[d] for d in domains)
    ps = []
    for f in feats:
        logs = []
        for d in domains:
            x = math.log((sizes[d] + 0.5) / (total + 0.5 * len(domains)))
            for k in range(1, 5):
                values = len({g[k] for g in feats if g[0] in domains}) + 1
                x += math.log((sum(g[k] == f[k] and g[0] == d for g in feats) + 0.5) / (sizes[d] + 0.5 * values))
            if f[0] in domains:
                x += math.log(0.98 if f[0] == d else 0.02 / max(1, len(domains) - 1))
            logs.append(x)
        e = np.exp(np.array(logs) - max(logs))
        ps.append(e / e.sum())
    p, n = np.array(ps), np.array(tokens, float)
    targets = np.array([sum(tokens) * weights[d] / sum(weights.values()) for d in domains])
    x, now = np.ones(len(rows)), n @ p
    held = now
    for _ in range(mixing.STEPS):
        if abs(now / targets - 1).max() <= mixing.CLOSE:
            break
        x = np.maximum(0, x - (p @ ((now - targets) / held) + mixing.PULL * (x - 1)) / (1 + mixing.PULL))
        before, now = now, (n * x) @ p
        if (abs(now - before) / targets).max() <= mixing.CLOSE / 10:
            break
    return {r[0]: (q, y) for r, q, y in zip(rows, ps, x)}, now, targets


@pytest.mark.parametrize("weights", [{"a": 1, "b": 1, "c": 1}, {"a": 0.05, "b": 3, "c": 0.2}])
def test_rates_equal_a_descent_over_documents(spark, weights):
    rows = corpus()
    want, now, targets = slow(rows, weights)
    got = {r.doc_id: r for r in mixing.mixed(spark.createDataFrame(rows, SCHEMA), weights).collect()}
    assert len(got) == len(rows)
    for d, (p, x) in want.items():
        assert got[d].rate == pytest.approx(x, abs=1e-6)
        assert got[d].domain_share == pytest.approx(p.max(), abs=1e-9)
    assert all(r.rate >= 0 for r in got.values())
    assert abs(now - targets).sum() < 0.03 * targets.sum()


def test_expected_tokens_meet_the_tempered_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.op4_soft_membership(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "source"), "doc_id").collect()
    held, now = Counter(), Counter()
    for r in rows:
        held[r.source] += r.tokens
        now[r.source] += r.tokens * r.rate
    scale = sum(held.values()) / sum(n**0.5 for n in held.values())
    assert all(abs(now[s] / (n**0.5 * scale) - 1) < 0.1 for s, n in held.items())


def test_no_sources_one_source_unnamed_and_zero_weights(spark):
    rows = corpus(60)
    docs = spark.createDataFrame(rows, SCHEMA)
    bare = spark.createDataFrame([(i, t, x, None) for i, t, x, _ in rows], SCHEMA)
    assert {r.rate for r in mixing.mixed(bare).collect()} == {1.0}
    one = mixing.mixed(docs, {"a": 1.0, "b": 0.0}).collect()
    assert {r.domain for r in one} == {"a"} and all(abs(r.rate - 1) < 1e-6 for r in one)
    absent = mixing.mixed(docs, {"a": 1.0, "zz": 1e-6}).collect()
    assert len(absent) == len(rows) and all(r.rate >= 0 for r in absent)
    assert mixing.mixed(docs.limit(0)).collect() == []


def test_stage_keeps_columns_and_rows(spark):
    rows = [(*r, 1.5, i) for i, r in enumerate(corpus(40) + corpus(2))]
    docs = spark.createDataFrame(rows, SCHEMA + ", rate double, domain int")
    out = mixing.with_rate(docs)
    assert out.columns == ["doc_id", "text", "lang", "source", "domain", "rate"]
    got = out.collect()
    assert sorted((r.domain, r.doc_id, r.text) for r in got) == sorted((r[5], r[0], r[1]) for r in rows) if all(r[1] for r in rows) else len(got) == len(rows)


def test_the_main_path_runs_no_python(spark, capsys):
    mixing.op4_soft_membership(spark, "/root/testdata/sf0.001").explain("formatted")
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


CELLS = "source string, lang string, size int, lines int, letters int, docs long, tokens long"


def uneven(spark):
    """One source of a million documents, nine of 200,000 and ten of 50, told apart by nothing else."""
    sizes = {"hot": 1_000_000} | {f"m{i}": 200_000 for i in range(9)} | {f"s{i}": 50 for i in range(10)}
    cells = spark.createDataFrame([(d, "en", 5, 5, 5, n, 100 * n) for d, n in sizes.items()], CELLS)
    return mixing.with_posterior(cells, sorted(sizes)), {d: 100 * n for d, n in sizes.items()}


def test_small_sources_are_not_outvoted(spark):
    known, held = uneven(spark)
    domains = sorted(held)
    for r in known.collect():
        assert domains[int(np.argmax(r.p))] == r.source and max(r.p) > 0.6


def test_uneven_sources_are_fitted_to_the_end(spark, monkeypatch):
    known, held = uneven(spark)
    domains = sorted(held)
    total = sum(n**0.5 for n in held.values())
    targets = [sum(held.values()) * held[d] ** 0.5 / total for d in domains]
    fitted, now = mixing.fit_rates(known, targets)
    rows = fitted.collect()
    p, n, x = np.array([r.p for r in rows]), np.array([r.tokens for r in rows], float), np.array([r.rate for r in rows])
    assert now == pytest.approx(list((n * x) @ p), rel=1e-9)
    slope = p @ (((n * x) @ p - targets) / (n @ p)) + mixing.PULL * (x - 1)
    assert all(abs(s) < 1e-6 if y > 0 else s > -1e-6 for s, y in zip(slope, x))
    assert all(abs(a / t - 1) < 0.2 for a, t in zip(now, targets))
    monkeypatch.setattr(mixing, "STEPS", 1)
    with pytest.raises(RuntimeError, match="miss their best"):
        mixing.fit_rates(known, targets)

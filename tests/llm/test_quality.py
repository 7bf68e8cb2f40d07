import zlib

import numpy as np
import pytest

from beaconlake.llm import quality


def rates(scores, labels):
    order = np.argsort(scores)
    rank = np.empty(len(scores))
    rank[order] = np.arange(len(scores))
    ones = labels.sum()
    return (rank[labels == 1].sum() - ones * (ones - 1) / 2) / (ones * (len(labels) - ones))


def test_encoding_of_single_and_many_passages():
    assert quality.encode(None).shape == quality.encode(" \n").shape == (1, quality.FEATURES)
    assert not quality.encode("").any()
    assert quality.encode("a " * 1001).shape == (11, quality.FEATURES)
    one = quality.encode("Aa bb bb 12 X!")[0]
    assert one[0] == pytest.approx(5 / 14) and one[14] == pytest.approx(1 / 5) and one[15] == pytest.approx(4 / 5)
    assert np.isfinite(quality.encode("漢字 \x00 " * 5000)).all()


def test_attention_finds_the_passages_that_matter():
    """Bags are good unless one of their passages is marked; only the bag has a label."""
    rng = np.random.default_rng(0)
    bags, labels = [], []
    for i in range(400):
        bag = rng.normal(size=(rng.integers(1, 12), quality.FEATURES)).astype(np.float32)
        bag[:, 3] = rng.normal(0, 0.1, len(bag))
        if i % 2:
            bag[rng.integers(len(bag)), 3] = 4
        bags.append(bag)
        labels.append(1 - i % 2)
    model = quality.fit(bags[:300], np.array(labels[:300]))
    assert rates(model.score(bags[300:]), np.array(labels[300:])) > 0.95
    hits = [model.attention(b).argmax() == b[:, 3].argmax() for b, y in zip(bags[300:], labels[300:]) if not y and len(b) > 1]
    assert np.mean(hits) > 0.8



def test_held_out_quality_on_given_documents(spark):
    dir_ = "/root/testdata/sf0.01"
    rows = quality.op1_attention(spark, dir_).join(spark.read.parquet(f"{dir_}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out]
    assert rates(np.array([r.score for r in held]), np.array([r.quality for r in held])) > 0.97


def test_held_out_labels_are_never_learned(spark):
    dir_ = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{dir_}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - quality, quality) quality")
    a, b = (sorted(map(tuple, quality.score_documents(docs, x).collect())) for x in (labels, turned))
    assert a == b


def test_nulls_repeats_extra_columns_and_empty(spark):
    rows = [(i, ("Plain words in a row. " if i % 2 else "### $$$ !!! ") * 20, i) for i in range(1, 41)]
    rows += [(100, None, 0), (101, "", 0), (None, "Plain words.", 0), (102, "Plain words in a row. " * 50_000, 0), (7, rows[6][1], 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    marks = [(i, i % 2, 0) for i in range(1, 41)] + [(3, 1, 0), (None, 1, 0), (100, None, 0), (999, 0, 0), (5, 7, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = quality.score_documents(docs, labels).collect()
    assert len(got) == len(rows)
    assert all(r.predicted == r.doc_id % 2 for r in got if r.doc_id and r.doc_id < 41)
    assert next(r.predicted for r in got if r.doc_id == 102) == 1
    assert [r.score for r in quality.score_documents(docs, labels.limit(0)).collect()] == [0.5] * len(rows)
    assert quality.score_documents(docs.limit(0), labels).collect() == []


def test_a_long_text_does_not_end_the_sample(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_PASSAGES", 30)
    rows = [(i, ("Plain words in a row. " if i % 2 else "### $$$ !!! ") * (2000 if i < 8 else 10)) for i in range(1, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 60)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda bags, labels: seen.append((len(bags), sum(map(len, bags)), set(labels))))
    quality.learn(docs, labels)
    assert seen == [(30, 30, {0.0, 1.0})]

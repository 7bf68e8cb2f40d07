import hashlib
import random
import re

import pytest

from beaconlake.llm import substrings

SCHEMA = "doc_id long, text string"


def slow(rows, window):
    words = {d: re.findall(r"[^\x20\x09-\x0D]+", t or "") for d, t in rows}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][i : i + window]), d)
    out = {}
    for d, w in words.items():
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def corpus(seed, n, vocabulary):
    rng = random.Random(seed)
    words = ["é", "aa", "b"] + [f"w{i}" for i in range(vocabulary)]
    shared = [[rng.choice(words) for _ in range(rng.randrange(3, 60))] for _ in range(6)]
    rows = []
    for i in range(n):
        doc = []
        for _ in range(rng.randrange(4)):
            doc += [rng.choice(words) for _ in range(rng.randrange(25))]
            if rng.random() < 0.7:
                doc += rng.choice(shared)
            if rng.random() < 0.1:
                doc += ["same"] * rng.randrange(40)
        rows.append((i * 7 % 1000, rng.choice([" ", "\n", " \x0b"]).join(doc)))
    return rows + [(1001, None), (1002, ""), (1003, " \t"), (1004, rows[0][1]), (1005, rows[3][1])]


@pytest.mark.parametrize("window, anchor, vocabulary", [(10, 3, 500), (12, 12, 3), (9, 1, 40)])
def test_equals_every_window_compared(spark, window, anchor, vocabulary):
    rows = corpus(window, 90, vocabulary)
    got = substrings.without_repeats(spark.createDataFrame(rows, SCHEMA), window, anchor).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == slow(rows, window)


def test_whole_corpus_at_production_settings(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = substrings.op10_substrings(spark, "/root/testdata/sf0.01").collect()
    want = slow(rows, 50)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == want
    assert sum(x[1] > 0 for x in want.values()) > 20


def test_stage_keeps_columns_rows_and_untouched_texts(spark):
    long = " ".join(f"x{i}" for i in range(60))
    rows = [(1, f"a  b {long}", 5, "s"), (2, f"new\n{long} tail", 6, "t"), (3, None, None, "u"), (None, long, 7, "v"), (4, "a  b", 4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, spans string")
    got = {r.spans: r for r in substrings.remove_repeats(docs).collect()}
    assert substrings.remove_repeats(docs).columns == docs.columns
    assert got["s"].text == rows[0][1] and got["s"].n_chars == 5
    assert (got["t"].text, got["t"].n_chars) == ("new tail", 8)
    assert got["u"].text is None and got["v"].text == long and got[None].text == "a  b"
    assert substrings.remove_repeats(docs.limit(0)).collect() == []
    assert substrings.without_repeats(docs.limit(0)).collect() == []


def test_rows_of_one_document_do_not_remove_each_other(spark):
    long = " ".join(f"x{i}" for i in range(70))
    got = substrings.without_repeats(spark.createDataFrame([(1, long), (1, long), (2, long)], SCHEMA)).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0), (1, 0), (2, 70)]

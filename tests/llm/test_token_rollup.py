import duckdb

from beaconlake.llm import token_rollup as t
from beaconlake.storage import scratch_path

DOCS = "doc_id long, text string, lang string, source string"


def held(rollup):
    return {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens, r.chars) for r in rollup.totals().collect()}


def counted(spark, rows):
    made = t.counts(spark.createDataFrame(rows, DOCS)).groupBy(*t.KEYS).agg({"*": "count", "tokens": "sum", "chars": "sum"})
    return {tuple(r[:3]): (r["count(1)"], r["sum(tokens)"], r["sum(chars)"]) for r in made.collect()}


def test_query_equals_its_sql(spark):
    dir_ = "/root/testdata/sf0.01"
    db = duckdb.connect()
    db.sql(f"create view documents as from '{dir_}/documents.parquet'")
    got = sorted(map(tuple, t.op7_delta_rollup(spark, dir_).select(*t.KEYS, *t.SUMS).collect()))
    assert got == sorted(db.sql(t.SQL).fetchall()) and len(got) > 50


def test_deltas_follow_the_corpus_and_batches_count_once(spark):
    old = [(1, "a b c", "en", "x"), (2, "d", "en", "x"), (3, None, None, None), (4, "e f", "de", "y"), (4, "e f", "de", "y")]
    new = [(1, "a b c d!", "en", "x"), (3, "g", None, None), (4, "e f", "de", "y"), (4, "e f", "fr", "y"), (5, "", "en", "z")]
    a, b = (t.counts(spark.createDataFrame(r, DOCS)) for r in (old, new))
    rollup = t.Rollup(spark, scratch_path(spark, "rollup"))
    assert held(rollup) == {}
    assert rollup.commit("one", t.signed(a, 1)) and not rollup.commit("one", t.signed(a, 1))
    assert held(rollup) == counted(spark, old)
    rollup.compact()
    assert held(rollup) == counted(spark, old) and not rollup.commit("one", t.signed(a, 1))
    assert rollup.commit("two", t.changes(a, b))
    rollup.compact()
    assert rollup.batches() == ["one", "two"] and held(rollup) == counted(spark, new)
    assert rollup.commit("three", t.signed(b, -1)) and held(rollup) == {}


def test_a_batch_that_fails_leaves_nothing(spark):
    rollup = t.Rollup(spark, scratch_path(spark, "rollup"))
    rows = t.signed(t.counts(spark.createDataFrame([(1, "a", "en", "x")], DOCS)), 1)
    broken = rows.selectExpr("source", "lang", "tokenizer", "docs", "tokens", "raise_error('no') + chars chars")
    try:
        rollup.commit("one", broken)
    except Exception:
        pass
    assert rollup.batches() == [] and held(rollup) == {}
    assert rollup.commit("one", rows) and len(held(rollup)) == 2


def test_empty_batch_and_extra_columns(spark):
    docs = spark.createDataFrame([(1, "a", "en", "x", 5)], DOCS + ", tokens int")
    rollup = t.Rollup(spark, scratch_path(spark, "rollup"))
    assert rollup.commit("none", t.signed(t.counts(docs.limit(0)), 1)) and held(rollup) == {}
    assert rollup.commit("some", t.signed(t.counts(docs), 1)) and held(rollup)[("x", "en", "words-1")] == (1, 1, 1)

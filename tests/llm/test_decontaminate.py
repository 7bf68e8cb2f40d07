import random

import numpy as np

from beaconlake.llm import decontaminate as d

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def items(rng, n, words):
    return [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 25)))) for i in range(n)]


def scores(index, terms):
    out = {}
    for block in index.blocks:
        for t in terms & block.keys():
            for item, x in block[t]:
                out[item] = out.get(item, 0) + x
    return out


def test_pivots_and_search_find_all_above_the_threshold_and_nothing_else():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(80)]
    index = d.Index(items(rng, 150, words))
    some = 0
    for _ in range(400):
        text = d.Text(" ".join(rng.sample(words, rng.randrange(1, 40))))
        terms = index.ids(text.hashes)
        held = set(terms.tolist()) - {-1}
        want = {i: round(s, 9) for i, s in scores(index, held).items() if s >= d.THRESHOLD - 1e-9}
        _, blocks = index.pivots(terms, np.zeros(len(terms), np.int64), 1)
        assert {i: round(s, 9) for b in blocks.tolist() for i, s in index.search(held, b)} == want
        some += len(want)
    assert some > 100


def test_words_of_any_script_and_hashes_by_word():
    assert d.words_of("Ab_1, É漢 x--y") == ["ab_1".encode(), "é漢".encode(), b"x", b"y"]
    assert d.words_of(None) == d.words_of(" ,;") == []
    words = ["noon", "onno", "no", "on", "é", "e"]
    assert len(set(d.Text(" ".join(words)).hashes.tolist())) == len(words)


def slow(docs, rows):
    """Pairs by shingles alone: an item's question and answer, each within a span of the text twice the longest item."""
    half = max([32, *(len(d.words_of(t)) for _, t in rows)])
    out = set()
    for doc, text in docs:
        words = d.words_of(text)
        for i in range(0, max(1, len(words)), half):
            for item, t in rows:
                q, a = (d.words_of(x) for x in d.parts_of(t))
                if not q + a:
                    continue
                question, answer = d.Item(item, d.shingles(q), set(a)).overlaps(words[i : i + 2 * half])
                if question >= 0.8 and answer >= 0.8:
                    out.add((doc, item))
    return out


def test_pairs_equal_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(500)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(8, 40))) + rng.choice(["", "? w1 w2", "?"])) for i in range(60)]
    docs = []
    for i in range(150):
        text = [rng.choice(words) for _ in range(rng.randrange(300))]
        for _ in range(rng.randrange(3)):
            item = rng.choice(rows)[1].split()
            if rng.random() < 0.5:
                item[rng.randrange(len(item))] = "changed"
            at = rng.randrange(len(text) + 1)
            text[at:at] = item
        docs.append((i, " ".join(text).upper()))
    got = d.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(rows, ITEMS)).collect()
    pairs = {(r.doc_id, r.item_id) for r in got}
    assert len(pairs) == len(got) > 100
    assert pairs == slow(docs, rows)


def test_given_documents(spark):
    dir_ = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{dir_}/documents.parquet").select("doc_id", "text").collect()]
    rows = [tuple(r) for r in spark.read.parquet(f"{dir_}/benchmark.parquet").select("item_id", "text").collect()]
    got = {(r.doc_id, r.item_id) for r in d.op3_block_max(spark, dir_).collect()}
    plain = {(x, i) for x, t in docs for i, b in rows if b in t}
    assert plain and plain <= got <= slow(docs, rows)


def test_nulls_repeats_extra_columns_and_empty(spark, monkeypatch):
    text = "one two three four five six seven eight nine"
    docs = spark.createDataFrame([(1, text, 1), (1, text, 2), (2, None, 3), (None, text, 4), (3, "", 5), (4, "clean", 6)], DOCS + ", item_id int")
    rows = [(1, text), (1, text), (2, None), (3, ""), (None, text), (4, "?"), (5, "one two three")]
    bench = spark.createDataFrame(rows, ITEMS)
    for shard in (2048, 1):
        monkeypatch.setattr(d, "SHARD_ITEMS", shard)
        monkeypatch.setattr(d, "SHARDS_AT_ONCE", 2)
        assert {(r.doc_id, r.item_id) for r in d.contaminated(docs, bench).collect()} == {(1, 1), (1, 5)}
    kept = d.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.item_id for r in kept.collect()) == [3, 4, 5, 6]
    assert d.contaminated(docs.limit(0), bench).collect() == []
    assert d.contaminated(docs, bench.limit(0)).collect() == []


def test_scores_do_not_hang_on_the_shards(spark, monkeypatch):
    rng = random.Random(13)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(8, 30)))) for i in range(90)]
    docs = [(i, " ".join([*(rng.choice(words) for _ in range(rng.randrange(80))), rng.choice(rows)[1], rng.choice(rows)[1]])) for i in range(60)]
    found = []
    for shard in (2048, 7):
        monkeypatch.setattr(d, "SHARD_ITEMS", shard)
        got = d.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(rows, ITEMS)).collect()
        found.append({(r.doc_id, r.item_id): (round(r.score, 9), r.question_overlap, r.answer_overlap) for r in got})
    assert found[0] == found[1] and len(found[0]) >= 100


def test_what_is_sent_grows_with_the_postings():
    rng = random.Random(2)
    index = d.Index([(i, " ".join(f"w{rng.randrange(60_000)}" for _ in range(100))) for i in range(d.SHARD_ITEMS)])
    assert len(index.most) <= 100 * d.SHARD_ITEMS and index.most.nbytes + index.block.nbytes + index.first.nbytes < 3_000_000

"""The whole pipeline on planted rows, every stage against what plain Python says of its input."""

import random
import re

import pytest

import corpus_pipeline
from beaconlake.llm import decontaminate, langid, mixing, simhash, substrings

WORDS = {
    "en": "the of and to in that with house water people from time small great under river garden window letter morning".split(),
    "de": "der die und das nicht mit haus wasser leute von zeit klein unter fluss garten fenster brief morgen immer wieder".split(),
}


def sentence(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", str(rng.randrange(900))]) for _ in range(n))


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rng = random.Random(31)
    rows = {i: (sentence(rng, lang, rng.randrange(70, 140)), lang, f"s{i % 3}") for i, lang in ((i, rng.choice(["en", "de"])) for i in range(10, 90))}
    passage, item = sentence(rng, "en", 60), sentence(rng, "en", 30)
    rows[3] = ("12 34 -- 56", "en", "s0")  # no letter
    rows[4] = (None, None, None)
    rows[91] = (rows[20][0], "en", "s1")  # an exact copy
    rows[92] = (rows[21][0].replace(rows[21][0].split()[40], "other", 1), rows[21][1], "s2")
    rows[93] = (sentence(rng, "en", 30) + " " + passage + " " + sentence(rng, "en", 40), "en", "s0")
    rows[94] = (sentence(rng, "en", 35) + " " + passage + " " + sentence(rng, "en", 45), "en", "s1")
    rows[95] = (sentence(rng, "en", 50) + " " + item + " " + sentence(rng, "en", 50), "en", "s2")  # a benchmark item
    root = tmp_path_factory.mktemp("planted")
    given = [(d, t, lang, source, len(t or ""), 77, "x") for d, (t, lang, source) in sorted(rows.items())]
    shape = "doc_id long, text string, lang string, source string, n_chars long, row int, _spans string"
    spark.createDataFrame(given, shape).write.parquet(str(root / "documents.parquet"))
    spark.createDataFrame([(1, item), (2, sentence(rng, "de", 25))], "item_id long, text string").write.parquet(str(root / "benchmark.parquet"))
    return str(root), {d: t for d, (t, *_) in rows.items()}, passage


def test_stages_and_their_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_dedup", "substring_dedup", "decontamination", "mixing"]


def test_every_stage_on_planted_rows(spark, planted):
    root, texts, passage = planted
    docs = spark.read.parquet(f"{root}/documents.parquet")
    columns = docs.columns

    def after(name):
        nonlocal docs
        docs = corpus_pipeline.pin(dict(corpus_pipeline.STAGES)[name](spark, docs, root), name)
        return {r.doc_id: r for r in docs.collect()}

    found = after("language_id")
    model = langid.learn(spark.createDataFrame([(r.text, r.lang) for r in spark.read.parquet(f"{root}/documents.parquet").collect() if not _held(r.doc_id)], "text string, lang string"))
    kept = {d for d, t in texts.items() if t and re.search(r"[^\W\d_]", t) and not model.decode(t)[2]}
    assert set(found) == kept and {3, 4}.isdisjoint(kept) and len(kept) > 80 and docs.columns == columns
    assert all(r.row == 77 and r._spans == "x" for r in found.values())

    prints = {d: simhash.fingerprint_of(texts[d]) for d in kept}
    group = {d: d for d in kept}
    changed = True
    while changed:  # smallest id over links, until nothing changes
        changed = False
        for a in kept:
            for b in kept:
                if (prints[a] ^ prints[b]).bit_count() <= 3 and group[b] < group[a]:
                    group[a], changed = group[b], True
    found = after("simhash_dedup")
    assert set(found) == {d for d in kept if group[d] == d} and 91 not in found and docs.columns == columns

    left = {d: texts[d].split() for d in found}
    gone = {}
    for d, words in left.items():
        windows = {tuple(words[i : i + 50]) for i in range(len(words) - 49)}
        earlier = [tuple(w[i : i + 50]) for e, w in left.items() if e < d for i in range(len(w) - 49)]
        shared = windows & set(earlier)
        cover = {i + k for i in range(len(words) - 49) if tuple(words[i : i + 50]) in shared for k in range(50)}
        gone[d] = " ".join(w for i, w in enumerate(words) if i not in cover) if cover else texts[d]
    found = after("substring_dedup")
    assert {d: r.text for d, r in found.items()} == gone and passage in found[93].text and passage not in found[94].text
    assert all(r.n_chars == len(r.text) for r in found.values()) and docs.columns == columns

    clean = {d for d, r in found.items() if not _contaminated(r.text, [r.text for r in spark.read.parquet(f"{root}/benchmark.parquet").collect()])}
    found = after("decontamination")
    assert set(found) == clean and 95 not in found and docs.columns == columns

    found = after("mixing")
    assert set(found) == clean and docs.columns == [*columns, "rate"] and all(r.rate >= 0 for r in found.values())
    expected = {r.doc_id: r.rate for r in mixing.mixed(spark.createDataFrame([(r.doc_id, r.text, r.lang, r.source) for r in found.values()], "doc_id long, text string, lang string, source string")).collect()}
    assert all(abs(r.rate - expected[d]) < 1e-6 for d, r in found.items())

    whole = {r.doc_id: (r.text, round(r.rate, 6)) for r in corpus_pipeline.run(spark, root).collect()}
    assert whole == {d: (r.text, round(r.rate, 6)) for d, r in found.items()}


def _held(doc_id):
    import zlib

    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def _contaminated(text, items):
    """Whether five sixths of an item's shingles and all that it asks are found anywhere in the text."""
    for item in items:
        question, answer = decontaminate.parts_of(item)
        words = decontaminate.words_of(text)
        wanted, held = decontaminate.shingles(decontaminate.words_of(question)), decontaminate.shingles(words)
        if wanted and len(wanted & held) >= decontaminate.OVERLAP * len(wanted) and len(set(decontaminate.words_of(answer)) & set(words)) >= decontaminate.OVERLAP * len(set(decontaminate.words_of(answer))):
            return True
    return False


def test_a_text_of_its_own_stays_whatever_its_doc_id(spark):
    rng = random.Random(5)
    a, b, c = (sentence(rng, "en", 60) for _ in range(3))
    rows = [(1, a, 77), (5, a, 77), (5, b, 77), (9, c, 77), (9, c, 77), (None, c, 77), (None, "lone words that nobody else has in a row", 77)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row int")
    found = sorted((r.doc_id or -1, r.text, r._row) for r in simhash.drop_near_duplicates(docs).collect())
    assert found == sorted([(1, a, 77), (5, b, 77), (9, c, 77), (-1, "lone words that nobody else has in a row", 77)])
    assert simhash.drop_near_duplicates(docs.limit(0)).collect() == []


def test_names_of_the_caller_clash_with_none(spark):
    rng = random.Random(8)
    names = ["row", "spans", "_spans", "_kept", "_row", "_tokens", "_cell", "hash", "fp", "place", "cut", "lang_pred", "component"]
    rows = [(i, sentence(rng, "en", 60), "en", "s", 5, *range(len(names))) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` int" for n in names))
    for stage in (langid.keep_identified, simhash.drop_near_duplicates, substrings.remove_repeats, mixing.with_rate):
        found = stage(docs)
        assert found.columns[: len(docs.columns)] == docs.columns
        assert {tuple(r)[5 : 5 + len(names)] for r in found.collect()} == {tuple(range(len(names)))}

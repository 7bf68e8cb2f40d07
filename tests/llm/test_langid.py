import zlib
from itertools import combinations

import numpy as np
import pytest

from beaconlake.llm import langid

SCHEMA = "doc_id long, text string, lang string"


@pytest.mark.parametrize("classes", [2, 4, 6, 7, 20])
def test_codewords_are_apart_and_bits_split(classes):
    codes = langid.codewords(classes)
    assert all((a != b).sum() >= min(4, 2 ** (classes - 2)) for a, b in combinations(codes, 2))
    assert all(len(set(bit)) == 2 for bit in codes.T)


def test_slots_see_letters_only():
    assert np.array_equal(langid.slots("Ab, 12 c"), langid.slots("ab -- C"))
    assert len(langid.slots("")) == 0
    assert len(langid.slots("ab")) == 3


def test_held_out_accuracy_on_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = langid.op5_output_codes(spark, "/root/testdata/sf0.01").join(docs, "doc_id").collect()
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) / len(held) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_labels_are_never_learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    spoiled = docs.selectExpr("doc_id", "text", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 'xx', lang) lang")
    a, b = (sorted(map(tuple, langid.languages_of(x).collect())) for x in (docs, spoiled))
    assert a == b


def test_nulls_empty_long_repeats_and_clashes(spark):
    rows = [(i, "the cat and the dog " * 3, "en", "x") for i in range(1, 20)] + [(i, "der hund und die katze " * 3, "de", None) for i in range(20, 40)]
    rows += [(50, None, "en", "a"), (51, "", None, "b"), (52, "12 ;-) 34", "de", "c"), (53, "the dog " * 400_000, None, "d"), (None, "die katze", None, "e"), (54, "the", "en", "f"), (54, "the", "en", "f")]
    docs = spark.createDataFrame(rows, SCHEMA + ", lang_pred string")
    got = langid.languages_of(docs).collect()
    assert len(got) == len(rows)
    said = {r.doc_id: r.lang_pred for r in got}
    assert [said[i] for i in (50, 51, 52)] == ["und"] * 3
    assert said[53] == said[54] == "en" and said[None] == "de"
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, *range(1, 40), 53, 54, 54]
    assert langid.languages_of(docs.limit(0)).collect() == []


def test_close_codewords_are_flagged():
    codes = langid.codewords(2)
    model = langid.Model(["a", "b"], codes, np.zeros((1 << langid.SLOT_BITS, 1), np.float32), np.ones(1))
    assert model.decode("any text") == ("a", 0.5, True)


def test_without_labels_everything_is_unknown(spark):
    docs = spark.createDataFrame([(1, "some text", None)], SCHEMA)
    assert [r.lang_pred for r in langid.languages_of(docs).collect()] == ["und"]

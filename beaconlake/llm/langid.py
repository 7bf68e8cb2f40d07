"""Language identification by error-correcting output codes.

Every language gets a codeword of bits; for every bit one binary classifier over character n-grams tells the languages
whose codeword has the bit from the others. A text is decoded to the language whose codeword loses least against all
classifiers' votes, each weighted by how well its classifier does on the texts it was learned from. If the second
codeword loses almost as little, the text is flagged as ambiguous.

Learning counts n-grams over all labelled texts on the executors: one row of counts per language and partition, summed
per language by slot. A classifier is the log-ratio of the smoothed n-gram shares of its two sides, so that the
model has a fixed size: 2 ** SLOT_BITS rows of one float per bit, whatever the number of texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.llm.common import packed, ship, table

SLOT_BITS = 15
ORDERS = (1, 2, 3)
#: A text is ambiguous if its best two codewords lose within this share of each other's loss.
MARGIN = 0.02
UNKNOWN = "und"
LETTER = r"\p{L}"
#: Texts are worked through in blocks of so many characters, whole.
BLOCK = 1 << 20


def codewords(classes: int) -> np.ndarray:
    """A codeword of -1 and 1 per class: all splits of up to 6 classes in two, else random ones kept far apart."""
    if classes < 2:
        return np.ones((classes, 1), np.int8)
    if classes <= 6:
        others = range(1, classes)
        splits = [s for n in range(1, classes) for s in combinations(others, n)]
        return np.array([[1 if c in s else -1 for s in splits] for c in range(classes)], np.int8)
    rng, best, apart = np.random.default_rng(7), None, -1
    for _ in range(200):
        made = rng.choice(np.array([-1, 1], np.int8), (classes, 15 + 4 * int(np.ceil(np.log2(classes)))))
        made = made[:, np.abs(made.sum(axis=0)) < classes]
        near = min(int((a != b).sum()) for a, b in combinations(made, 2))
        if near > apart:
            best, apart = made, near
    return best


def slots(text: str) -> np.ndarray:
    """The hashed n-grams of a text: lower case, anything but letters as one space."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    ascii_ = points < 128
    letter = np.where(ascii_, (points >= 97) & (points <= 122), points > 191)
    points = np.where(letter, points, 32).astype(np.uint64)
    points = points[~((points[:] == 32) & np.concatenate([[False], points[:-1] == 32]))] if len(points) else points
    found = []
    for order in ORDERS:
        if len(points) < order:
            break
        mixed = np.full(len(points) - order + 1, order, np.uint64)
        for i in range(order):
            mixed = (mixed ^ points[i : len(points) - order + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        found.append((mixed >> np.uint64(64 - SLOT_BITS)).astype(np.int32))
    return np.concatenate(found) if found else np.zeros(0, np.int32)


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """n-gram counts per language, in one pass over a partition."""
    held: dict[str, np.ndarray] = {}
    texts: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            to = held.setdefault(lang, np.zeros(1 << SLOT_BITS, np.int64))
            texts[lang] = texts.get(lang, 0) + 1
            for at in range(0, len(text), BLOCK):
                to += np.bincount(slots(text[at : at + BLOCK]), minlength=1 << SLOT_BITS)
    for lang, counts in held.items():
        used = np.flatnonzero(counts)
        yield pd.DataFrame({"lang": lang, "slot": used, "n": counts[used]})
        yield pd.DataFrame({"lang": lang, "slot": [-1], "n": [texts[lang]]})


@dataclass
class Model:
    """`languages`, their `codes` (language, bit), `weights` (slot, bit), `offset` per bit and each bit's `trust`."""

    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    trust: np.ndarray

    def votes(self, text: str) -> np.ndarray:
        """Mean evidence of the text's n-grams, one number per bit."""
        total, n = np.zeros(self.codes.shape[1]), 0
        for at in range(0, len(text), BLOCK):
            found = slots(text[at : at + BLOCK])
            total += np.bincount(found, minlength=len(self.weights)) @ self.weights if len(found) > 20_000 else self.weights[found].sum(axis=0, dtype=np.float64)
            n += len(found)
        return total / max(1, n)

    def decode(self, text: str) -> tuple[str, float, bool]:
        """The language, its share of the soft-min over losses, and whether the choice is ambiguous."""
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        loss = np.log1p(np.exp(-8.0 * self.codes * self.votes(text))) @ self.trust
        order = np.argsort(loss, kind="stable")
        share = np.exp(-(loss - loss[order[0]]) * 8.0)
        near = loss[order[1]] - loss[order[0]] <= MARGIN * loss[order[1]]
        return self.languages[order[0]], float(share[order[0]] / share.sum()), bool(near)


def learn(labelled: DataFrame) -> Model | None:
    """A model from all rows of `labelled` (text, lang) with both; None without any. Ties in codewords go by name."""
    given = labelled.select("lang", "text").where("lang is not null and text is not null")
    summed = given.mapInPandas(_counts, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    rows = summed.toPandas()  # at most 2 ** SLOT_BITS + 1 a language
    if not len(rows):
        return None
    languages = sorted(rows["lang"].unique())
    counts = np.zeros((len(languages), 1 << SLOT_BITS))
    ngrams = rows[rows["slot"] >= 0]
    np.add.at(counts, (np.searchsorted(languages, ngrams["lang"]), ngrams["slot"]), ngrams["n"])
    shares = (counts + 0.05) / (counts + 0.05).sum(axis=1, keepdims=True)
    codes = codewords(len(languages))
    weights = np.stack([np.log(shares[b > 0].mean(axis=0) / shares[b <= 0].mean(axis=0)) if len(set(b)) > 1 else np.zeros(1 << SLOT_BITS) for b in codes.T], axis=1)
    # a bit is trusted by how far apart the mean evidence of its two sides lies
    apart = (shares @ weights * codes).mean(axis=0)
    trust = np.maximum(apart, 1e-9)
    return Model(list(languages), codes, weights.astype(np.float32), trust / trust.sum())


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """`docs` with `lang_pred`, `lang_score` and `lang_ambiguous`, from `text` alone.

    A null text, or one without a letter, is `und` with score 0, and so is every text if there is no model.
    """
    bits = docs.sparkSession.sparkContext.broadcast(model)  # of a size fixed by SLOT_BITS and the languages

    def predict(texts: pd.Series) -> pd.DataFrame:
        model = bits.value
        found = [model.decode(t) if t is not None and model else (UNKNOWN, 0.0, False) for t in texts]
        return pd.DataFrame(found, columns=["lang", "score", "ambiguous"])

    said = F.pandas_udf(predict, "lang string, score double, ambiguous boolean")(F.when(F.col("text").rlike(LETTER), F.col("text")))
    return docs.withColumn("_said", said).select(
        *(F.col(f"`{c}`") for c in docs.columns),
        F.col("_said.lang").alias("lang_pred"), F.col("_said.score").alias("lang_score"), F.col("_said.ambiguous").alias("lang_ambiguous"),
    )


def remainder(key: str, of: int) -> Column:
    """crc32 of an id as text, modulo `of`; null for a null id."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % of


def held_out(docs: DataFrame) -> Column:
    return F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))


def languages_of(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and ambiguous for every row; learned from the rows not held out.

    Rows without doc_id count as not held out. Repeated rows come back as often as they came, other columns are ignored.
    """
    rows = docs.select("doc_id", "text", "lang")
    model = learn(rows.where(~held_out(rows)))
    told = identify(rows.select("doc_id", "text", held_out(rows).alias("held_out")), model)
    return told.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"), F.col("lang_ambiguous").alias("ambiguous"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """`docs` without rows whose language can't be told: no letter, or ambiguous. Without any labelled row all stay."""
    model = learn(docs.where(~held_out(docs)))
    told = identify(packed(docs, "text"), model)
    kept = told.where(F.col("lang_pred").isNotNull() & (F.col("lang_pred") != UNKNOWN) & ~F.col("lang_ambiguous"))
    return kept.select("row.*") if model else docs


def op5_output_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages_of(table(spark, sf_dir, "documents"))


ship(__name__)

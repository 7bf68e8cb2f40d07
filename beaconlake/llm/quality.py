"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of `PASSAGE` words, of which only the bag has a label. Every passage is encoded as a
vector of shares and moments over its characters and words. A gated attention layer, tanh(V h) * sigmoid(U h) against a
vector w, weighs the passages; the weighted sum of their hidden representations is scored by a logistic unit. All
layers are learned together from document labels by gradient descent.

Learning sees a bounded sample of labelled documents: of those least by a hash of their id, at most `SAMPLE_DOCS`, and of
these, in that order, each that still fits into `SAMPLE_PASSAGES` passages together. Passages are counted first, and only
the chosen documents are encoded for learning. Encoding and scoring see every passage of every text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.llm.common import WORD, ship, table
from beaconlake.llm.langid import remainder

PASSAGE = 100
SAMPLE_DOCS = 8_000
SAMPLE_PASSAGES = 120_000
HIDDEN, ATTENTION = 24, 16
STEPS, RATE, DECAY = 400, 0.02, 1e-4
CUT = 0.3

_KINDS = ["a-z", "A-Z", "0-9", "\n", " ", ".,", "!?", "#$%&*@", "|<>{}[]=\\^~_", "-'\":;()/", "other", "high"]
_CLASS = np.full(256, 10, np.uint8)
_CLASS[[*range(97, 123)]], _CLASS[[*range(65, 91)]], _CLASS[[*range(48, 58)]] = 0, 1, 2
for _k in (3, 4, 5, 6, 7, 8, 9):
    _CLASS[[ord(c) for c in _KINDS[_k]]] = _k
_CLASS[128:] = 11
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LETTER = np.random.default_rng(11).integers(1 << 63, size=256, dtype=np.uint64)
#: Character shares, then: mean and spread of word lengths, shares of words that repeat the word before, that are new to
#: the passage, all capitals, end in a symbol, are short or long, and the passage's own length.
FEATURES = len(_KINDS) + 9


def encode(text: str | None) -> np.ndarray:
    """One row of features per passage; a text without a word is one passage of zeros."""
    raw = (text or "").encode("utf-8", "replace")
    data = np.frombuffer(raw, np.uint8)
    inside = np.concatenate([[False], ~_SPACE[data], [False]])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = turns[::2], turns[1::2]
    n = len(begin)
    if not n:
        return np.zeros((1, FEATURES), np.float32)
    passages = -(-n // PASSAGE)
    of = np.arange(n) // PASSAGE
    first = np.arange(passages) * PASSAGE
    out = np.zeros((passages, FEATURES))
    starts = begin[first]
    starts[0] = 0
    sizes = np.diff(np.append(starts, len(data)))
    kinds = np.bincount(np.repeat(np.arange(passages), sizes) * len(_KINDS) + _CLASS[data], minlength=passages * len(_KINDS))
    out[:, : len(_KINDS)] = kinds.reshape(passages, -1) / sizes[:, None]
    length = end - begin
    words = np.bincount(of)
    letters = data[~_SPACE[data]]
    offset = np.cumsum(length) - length
    place = (np.arange(len(letters)) - np.repeat(offset, length)).astype(np.uint64)
    named = np.add.reduceat(_LETTER[letters] * (place * np.uint64(2) + np.uint64(1)), offset)
    mean = lambda x: np.add.reduceat(x.astype(np.float64), first) / words
    average = mean(length)
    again = np.concatenate([[False], named[1:] == named[:-1]])
    kind = _CLASS[letters]
    capital = np.add.reduceat((kind == 1).astype(np.int64), offset)
    known, seen = np.unique(of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ named, return_index=True)
    last = _CLASS[data[end - 1]]
    more = [
        np.log1p(average), np.sqrt(np.maximum(mean(length.astype(np.float64) ** 2) - average**2, 0)) / (1 + average), mean(again),
        np.bincount(of[seen], minlength=passages) / words, mean((capital == length) & (length > 1)), mean((last == 6) | (last == 7) | (last == 8)),
        mean(length <= 2), mean(length >= 12), np.log1p(words) / math.log(PASSAGE + 1),
    ]
    out[:, len(_KINDS) :] = np.stack(more, axis=1)
    return out.astype(np.float32)


@dataclass
class Model:
    """Means and scales of the features, and the weights of all layers."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """All layers over passages `x` whose bags begin at `starts`."""
        w, sizes = self.weights, np.diff(np.append(starts, len(x)))
        h = np.tanh(x @ w["E"] + w["e"])
        v, u = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
        s = (v * u) @ w["w"]
        a = np.exp(s - np.repeat(np.maximum.reduceat(s, starts), sizes))
        a /= np.repeat(np.add.reduceat(a, starts), sizes)
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return {"h": h, "v": v, "u": u, "a": a, "z": z, "p": 1 / (1 + np.exp(-np.clip(z @ w["o"] + w["b"], -40, 40)))}

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        starts = np.cumsum([0, *map(len, bags[:-1])])
        return self.forward(self.scaled(np.concatenate(bags)), starts)["p"]

    def attention(self, bag: np.ndarray) -> np.ndarray:
        """How much each passage of a document counts."""
        return self.forward(self.scaled(bag), np.array([0]))["a"]


def fit(bags: list[np.ndarray], labels: np.ndarray, seed: int = 1) -> Model:
    """Learns all layers by gradient descent with moments on the mean logistic loss over bags."""
    x = np.concatenate(bags).astype(np.float64)
    model = Model(x.mean(axis=0), x.std(axis=0) + 1e-3, {})
    x = model.scaled(x)
    sizes = np.array([len(b) for b in bags])
    starts, bag = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(bags)), sizes)
    rng = np.random.default_rng(seed)
    draw = lambda *s: rng.normal(0, 1 / math.sqrt(s[0]), s)
    w = {"E": draw(x.shape[1], HIDDEN), "e": np.zeros(HIDDEN), "V": draw(HIDDEN, ATTENTION), "U": draw(HIDDEN, ATTENTION), "w": draw(ATTENTION), "o": draw(HIDDEN), "b": np.zeros(1)}
    model.weights = w
    m, s = ({k: np.zeros_like(t) for k, t in w.items()} for _ in range(2))
    for step in range(1, STEPS + 1):
        f = model.forward(x, starts)
        h, a, v, u = f["h"], f["a"], f["v"], f["u"]
        d = (f["p"] - labels) / len(bags)
        dz = d[:, None] * w["o"]
        da = (h * dz[bag]).sum(axis=1)
        ds = a * (da - np.add.reduceat(a * da, starts)[bag])
        dv, du = ds[:, None] * w["w"] * u * (1 - v**2), ds[:, None] * w["w"] * v * u * (1 - u)
        dh = (a[:, None] * dz[bag] + dv @ w["V"].T + du @ w["U"].T) * (1 - h**2)
        grads = {"E": x.T @ dh, "e": dh.sum(axis=0), "V": h.T @ dv, "U": h.T @ du, "w": (v * u).T @ ds, "o": f["z"].T @ d, "b": d.sum(keepdims=True)}
        for k, g in grads.items():
            g = g + DECAY * w[k]
            m[k] = 0.9 * m[k] + 0.1 * g
            s[k] = 0.999 * s[k] + 0.001 * g**2
            w[k] -= RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
    return model


def _encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch[["hash", "id", "label"]].assign(bag=[encode(t).tobytes() for t in batch["text"]])


def learn(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model from `labels` (doc_id, quality) and the texts of `docs`; None if a label of either kind is missing.

    A document with several labels has the largest. The sample is the same whatever the order of the rows.
    """
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").cast("double").alias("label"))
    pick = F.struct(F.xxhash64("doc_id").alias("hash"), F.col("doc_id").alias("id"))
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "label", pick.alias("pick"))
    sample = known.orderBy("pick").limit(SAMPLE_DOCS)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most SAMPLE_DOCS rows of numbers
    texts = texts.select("label", "pick", F.xxhash64("text").alias("of"), "text")
    passages = F.greatest(F.lit(1), F.ceil(F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)) / PASSAGE)).cast("long")
    sizes = texts.select("pick", "of", passages.alias("passages")).toPandas()  # numbers of the sample's rows
    sizes = sizes.assign(hash=[p["hash"] for p in sizes["pick"]], id=[p["id"] for p in sizes["pick"]]).sort_values(["hash", "id", "of"])
    chosen, left = [], SAMPLE_PASSAGES
    for row in sizes.drop_duplicates(["hash", "id", "of"]).itertuples():
        if row.passages <= left:  # one that does not fit leaves its place to those after it
            chosen.append((row.id, row.of))
            left -= row.passages
    wanted = docs.sparkSession.createDataFrame(chosen, "id long, of long")
    met = texts.join(F.broadcast(wanted), (F.col("pick.id") == F.col("id")) & texts["of"].eqNullSafe(wanted["of"]))
    bags = met.select("text", "label", F.col("pick.hash"), "id").dropDuplicates(["id", "text"]).mapInPandas(_encoded, "hash long, id long, label double, bag binary")
    rows = bags.toPandas().sort_values(["hash", "id", "bag"])
    if rows["label"].nunique() < 2:
        return None
    return fit([np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in rows["bag"]], rows["label"].to_numpy())


def quality_score(text: Column, model: Model | None, spark: SparkSession) -> Column:
    """Score of each text, 0 to 1; without a model 0.5."""
    sent = spark.sparkContext.broadcast(model)

    def score(texts: pd.Series) -> pd.Series:
        if sent.value is None or not len(texts):
            return pd.Series(np.full(len(texts), 0.5))
        return pd.Series(sent.value.score([encode(t) for t in texts]))

    return F.pandas_udf(score, "double")(text)


def held_out(docs: DataFrame) -> Column:
    return F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of `docs`; learned from labels of rows not held out.

    Null and empty texts are scored as one empty passage. Labels without a document, and documents without a label, are
    not learned from. Repeated rows come back as often as they came; other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    learned = docs.where(~held_out(docs))
    model = learn(learned, labels.select("doc_id", "quality"))
    scored = docs.select("doc_id", held_out(docs).alias("held_out"), quality_score(F.col("text"), model, docs.sparkSession).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def op1_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ship(__name__)

"""Repeated passages: a de Bruijn graph of token k-mers, compacted before it is compared.

The graph's edges are the windows of `WINDOW` consecutive words. Writing one row per edge would multiply the corpus, so
paths are compacted where they are made: every window has an anchor, the `ANCHOR`-word k-mer of least hash in it
(leftmost on ties), and consecutive windows of a document with the same anchor are one path piece, described by its
coordinates (document, start, number of windows) and 128 bits of hash over its words. Windows of equal words have
the same anchor, so all that must meet does meet under it:

* an anchor seen in one document only has nothing to share;
* an anchor with one piece in all documents is a path without branches, settled as a whole by its first document;
* at an anchor with several pieces the graph branches. A piece seen in an earlier document is settled as a whole; only
  the first document of each different piece is opened into single windows, which are then joined on their own hashes.

Coordinates lead back to the words: every span is named by document and position, found again in the whole text, and
taken out there. Two texts are held equal if two independent 64-bit hashes over their words agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.llm.common import packed, ship, table
from beaconlake.storage import pin

WINDOW = 50
ANCHOR = 8
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _odd(seed: int) -> int:
    return int(np.random.default_rng(seed).integers(1 << 62, dtype=np.uint64)) * 2 + 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over the whole number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of a text with hashes of any run of them."""

    _byte = [np.random.default_rng(s).integers(1 << 63, size=256, dtype=np.uint64) for s in (1, 2)]
    _letter, _word = [_odd(3), _odd(4)], [_odd(5), _odd(6)]
    _inverse = [pow(x, -1, 1 << 64) for x in _word]

    def __init__(self, text: str | None) -> None:
        self.raw = (text or "").encode("utf-8", "replace")
        data = np.frombuffer(self.raw, np.uint8)
        inside = np.concatenate([[False], ~_SPACE[data], [False]])
        turns = np.flatnonzero(inside[1:] != inside[:-1])
        self.begin, self.end = turns[::2], turns[1::2]
        self.n = len(self.begin)
        self._data = data

    def hash(self) -> None:
        """Prefix sums of two word hashes; a run's hash is a difference of two of them, brought to position 0."""
        n, lengths = self.n, self.end - self.begin
        self._sums, self._up = [], []
        if not n:
            return
        longest = int(lengths.max())
        letters = self._data[~_SPACE[self._data]]
        place = np.arange(len(letters)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        starts = np.cumsum(lengths) - lengths
        for side in (0, 1):
            value = self._byte[side][letters] * _powers(self._letter[side], longest)[place]
            word = _mixed(np.add.reduceat(value, starts) + lengths.astype(np.uint64))
            self._sums.append(np.concatenate([[np.uint64(0)], np.cumsum(word * _powers(self._inverse[side], n), dtype=np.uint64)]))
            self._up.append(_powers(self._word[side], n + 1))

    def runs(self, side: int, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        sums = self._sums[side]
        return _mixed((sums[start + length] - sums[start]) * self._up[side][start] + np.asarray(length).astype(np.uint64))

    def pieces(self, window: int, anchor: int) -> tuple[np.ndarray, ...]:
        """start, number of windows and anchor hash of every path piece."""
        n = self.n - window + 1
        order = self.runs(0, np.arange(self.n - anchor + 1), anchor)
        at, reach, width = np.arange(len(order)), 1, window - anchor + 1
        while reach < width:  # the leftmost least k-mer of spans of doubling width
            step = min(reach, width - reach)
            left, right = at[:-step], at[step:]
            at = np.where(order[left] <= order[right], left, right)
            reach += step
        start = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        return start, np.diff(np.concatenate([start, [n]])), order[at[start]]


def _long(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _path_pieces(window: int, anchor: int):
    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                words = Words(text)
                if words.n < window:
                    continue
                words.hash()
                start, count, least = words.pieces(window, anchor)
                spans = count + window - 1
                made.append(np.stack([np.full(len(start), doc), start, count, _long(least), *(_long(words.runs(s, start, spans)) for s in (0, 1))]))
            if made:
                yield pd.DataFrame(np.concatenate(made, axis=1).T, columns=["doc_id", "start", "windows", "anchor", "h1", "h2"])

    return make


def _windows(window: int):
    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for doc, text, spans in zip(batch["doc_id"], batch["text"], batch["spans"]):
                words = Words(text)
                words.hash()
                at = np.unique(np.concatenate([np.arange(s["start"], s["start"] + s["windows"]) for s in spans]))
                at = at[at + window <= words.n]
                for part in np.array_split(at, len(at) // 100_000 + 1):
                    yield pd.DataFrame({"doc_id": doc, "start": part, "h1": _long(words.runs(0, part, window)), "h2": _long(words.runs(1, part, window))})

    return make


def repeated_spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, start, windows): runs of windows, by the position of their first word, that start in an earlier document.

    Every window of `window` words whose words also start in a document with a smaller doc_id is in one of them, and
    no other. Texts shorter than a window and null texts have none. Rows without doc_id neither give nor lose anything.
    Rows that share a doc_id don't remove from each other; they are taken to hold the same text.
    """
    given = docs.select("doc_id", "text").where("doc_id is not null and text is not null")
    shape = "doc_id long, start int, windows int, anchor long, h1 long, h2 long"
    pieces = pin(given.mapInPandas(_path_pieces(window, anchor), shape), "pieces")
    met = pieces.groupBy("anchor").agg(
        F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"),
        *(f("h" + s).alias(f.__name__ + s) for s in "12" for f in (F.min, F.max)),
    ).where("lo < hi").select("anchor", F.expr("min1 <> max1 or min2 <> max2").alias("branches"))
    shared = pin(pieces.join(met, "anchor"), "shared")
    first = shared.groupBy("h1", "h2").agg(F.min("doc_id").alias("owner"))
    owned = pin(shared.join(first, ["h1", "h2"]).select("doc_id", "start", "windows", "branches", (F.col("doc_id") > F.col("owner")).alias("settled")), "owned")
    settled = owned.where("settled").select("doc_id", "start", "windows")
    open_ = owned.where("branches and not settled")
    spans = open_.groupBy("doc_id").agg(F.collect_list(F.struct("start", "windows")).alias("spans"))
    opened = given.join(spans, "doc_id").mapInPandas(_windows(window), "doc_id long, start int, h1 long, h2 long")
    opened = pin(opened, "windows")
    firsts = opened.groupBy("h1", "h2").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
    late = opened.join(firsts, ["h1", "h2"]).where("doc_id > lo").select("doc_id", "start", F.lit(1).alias("windows"))
    return settled.unionAll(late.distinct())


def _without(window: int):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = []
            for text, spans in zip(batch["text"], batch["spans"]):
                words = Words(text)
                gone = np.zeros(words.n + 1, np.int64)
                if spans is not None:
                    start = np.fromiter((s["start"] for s in spans), np.int64, len(spans))
                    stop = np.fromiter((s["windows"] for s in spans), np.int64, len(spans)) + start + window - 1
                    np.add.at(gone, np.minimum(start, words.n), 1)
                    np.add.at(gone, np.minimum(stop, words.n), -1)
                gone = np.cumsum(gone)[: words.n] > 0
                removed, raw = int(gone.sum()), words.raw
                kept = b" ".join(raw[b:e] for b, e in zip(words.begin[~gone].tolist(), words.end[~gone].tolist()))
                left = text if not removed else kept.decode("utf-8")
                made.append((words.n, removed, hashlib.sha256(kept).hexdigest(), left))
            yield batch.drop(columns=["text", "spans"]).assign(**dict(zip(("n_words", "n_removed", "kept_sha256", "text"), map(list, zip(*made)))) if made else {c: [] for c in ("n_words", "n_removed", "kept_sha256", "text")})

    return cut


def without_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and text, one row per row of `docs` (doc_id, text).

    `text` is the given one where nothing goes, else the kept words joined by one space. A null text has no words and
    stays null. Other columns are ignored.
    """
    spans = repeated_spans(docs, window, anchor)
    spans = spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "windows")).alias("spans"))
    shape = "doc_id long, n_words long, n_removed long, kept_sha256 string, text string"
    return docs.select("doc_id", "text").join(spans, "doc_id", "left").mapInPandas(_without(window), shape)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """`docs` with repeated passages taken out of `text`, and `n_chars`, where there is one, counted again."""
    spans = repeated_spans(docs).groupBy("doc_id").agg(F.collect_list(F.struct("start", "windows")).alias("spans"))
    cut = _without(WINDOW)

    def kept(texts: pd.Series, found: pd.Series) -> pd.Series:
        return pd.concat([x["text"] for x in cut(iter([pd.DataFrame({"text": texts, "spans": found})]))]).set_axis(texts.index)

    hit = packed(docs, "doc_id", "text").join(spans, "doc_id", "left")
    text = F.when(F.col("spans").isNotNull(), F.pandas_udf(kept, "string")("text", "spans")).otherwise(F.col("text"))
    hit = hit.select("row", text.alias("text"), F.col("spans").isNotNull().alias("cut"))

    def column(name: str) -> Column:
        own = F.col("row")[name]
        if name == "text":
            return F.col("text")
        if name == "n_chars":
            return F.when(F.col("cut"), F.length("text").cast(docs.schema[name].dataType)).otherwise(own).alias(name)
        return own.alias(name)

    return hit.select(*map(column, docs.columns))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).drop("text")


ship(__name__)

"""Benchmark decontamination: a BM25 index of test items, searched by every passage with block-max WAND.

Items are the indexed side, passages of the training texts are the queries. A term's impact on an item is divided by the
item's score for its own text, so that one threshold, a share of that score, fits items of any length. Posting
lists are in item order and cut into blocks, of which the largest impact is kept; the blocks of all lists end at the same
items. The sum of a passage's block maxima bounds the score of any item of the block. As the threshold is fixed, the
pivots, blocks where the lists' maxima can reach it, are found for many passages at once; every list skips to them and
over all else. In a pivot block terms are scored by falling impact, until what is left can't reach the threshold.
No item at or above the threshold is missed.

Found items are then verified: of the five-word shingles of the question, and of the words of the answer, the share that
the passage holds must reach 0.8.

Items go to executors in shards of at most `SHARD_ITEMS` items, each shard an index of its own; term frequencies and the mean
length are those of all items, so that scores don't hang on the shards. Block maxima are kept per posting. The texts are read once per `SHARDS_AT_ONCE` shards. Passages overlap by half and are twice as long as the longest
item, so that every occurrence of an item lies within one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.llm.common import ship, table
from beaconlake.storage import pin

K1, B = 1.2, 0.75
#: Share of an item's own score that a passage must reach.
THRESHOLD = 0.5
OVERLAP = 0.8
SHINGLE = 5
BLOCK = 2
SHARD_ITEMS = 2048
SHARDS_AT_ONCE = 8
LEAST_PASSAGE = 32
#: Texts are searched together up to so many words.
TOGETHER = 1 << 19
#: Words are runs of ASCII letters, digits and underscores, and of anything that is not ASCII; in lower case.
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), 95, *range(97, 123), *range(128, 256)]] = True
_BYTE = np.random.default_rng(21).integers(1 << 63, size=256, dtype=np.uint64)
_STEP = 0xD1342543DE82EF95


class Text:
    """The words of a text: where each begins and ends, and its hash."""

    def __init__(self, text: str | None) -> None:
        self.raw = (text or "").lower().encode("utf-8", "replace")
        data = np.frombuffer(self.raw, np.uint8)
        inside = _INSIDE[data]
        turns = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        self.begin, self.end = turns[::2], turns[1::2]
        length = self.end - self.begin
        self.hashes = np.zeros(0, np.uint64)
        if len(length):
            letters, first = data[inside], np.cumsum(length) - length
            powers = np.cumprod(np.full(int(length.max()), _STEP, np.uint64), dtype=np.uint64)
            place = np.arange(len(letters)) - np.repeat(first, length)
            mixed = np.add.reduceat(_BYTE[letters] * powers[place], first) + length.astype(np.uint64)
            self.hashes = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)

    def words(self, start: int = 0, stop: int | None = None) -> list[bytes]:
        return [self.raw[b:e] for b, e in zip(self.begin[start:stop].tolist(), self.end[start:stop].tolist())]


def words_of(text: str | None) -> list[bytes]:
    return Text(text).words()


def parts_of(text: str | None) -> tuple[str, str]:
    """Question and answer: what follows the last question mark is the answer; without one all is the question."""
    asked, mark, answer = (text or "").rpartition("?")
    return (asked + mark, answer) if mark else (answer, "")


def shingles(words: list[bytes]) -> set[tuple[bytes, ...]]:
    return {tuple(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))} if words else set()


@dataclass
class Item:
    item_id: int
    question: set = field(default_factory=set)
    answer: set = field(default_factory=set)

    def overlaps(self, words: list[bytes]) -> tuple[float, float]:
        """Shares of the question's shingles and the answer's words that `words` holds; an absent part counts as 1."""
        held = set(words)
        found = shingles(words)
        if short := {len(s) for s in self.question if len(s) < SHINGLE}:
            n = short.pop()
            found |= {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
        question = len(self.question & found) / len(self.question) if self.question else 1.0
        answer = len(self.answer & held) / len(self.answer) if self.answer else 1.0
        return question, answer


@dataclass
class Statistics:
    """Of all items: how many have a word, their mean and largest length, and of some terms the number of items that have
    each."""

    items: int
    mean: float
    longest: int
    terms: np.ndarray
    spread: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Statistics:
        words = [w for w in (Text(t).hashes for t in texts) if len(w)]
        terms, spread = np.unique(np.concatenate([np.unique(w) for w in words]), return_counts=True) if words else (np.zeros(0, np.uint64), np.zeros(0))
        return cls(len(words), sum(map(len, words)) / max(1, len(words)), max(map(len, words), default=0), terms, spread)


class Index:
    """Posting lists with block maxima over the items of one shard; `known` has the statistics of all shards' items."""

    def __init__(self, rows: list[tuple[int, str]], known: Statistics | None = None) -> None:
        known = known or Statistics.of([t for _, t in rows])
        texts = [(i, Text(t), t) for i, t in rows]
        texts = sorted((x for x in texts if len(x[1].hashes)), key=lambda x: (len(x[1].hashes), x[0]))
        self.items = [Item(i, shingles(words_of(q)), set(words_of(a))) for i, _, t in texts for q, a in [parts_of(t)]]
        words = [t.hashes for _, t, _ in texts]
        self.half = max(LEAST_PASSAGE, known.longest)
        self.terms = np.unique(np.concatenate(words)) if words else np.zeros(0, np.uint64)
        found = [np.unique(self.ids(w), return_counts=True) for w in words]
        spread = known.spread[np.searchsorted(known.terms, self.terms)] if words else np.zeros(0)
        rarity = np.log1p((known.items - spread + 0.5) / (spread + 0.5))
        #: Of each block and term in it: the postings (item, impact).
        self.blocks: list[dict[int, list[tuple[int, float]]]] = [{} for _ in range(-(-len(words) // BLOCK))]
        for at, (ids, counts) in enumerate(found):
            impact = rarity[ids] * counts * (K1 + 1) / (counts + K1 * (1 - B + B * counts.sum() / known.mean))
            impact /= impact.sum()
            for t, x in zip(ids.tolist(), impact.tolist()):
                self.blocks[at // BLOCK].setdefault(t, []).append((at, x))
        #: The blocks of each term's list, one list after the other from `first` on, and the largest impact in each.
        listed = sorted((t, b, max(x for _, x in held)) for b, lists in enumerate(self.blocks) for t, held in lists.items())
        self.first = np.searchsorted(np.array([t for t, _, _ in listed], np.int64), np.arange(len(self.terms) + 1))
        self.block = np.array([b for _, b, _ in listed], np.int32)
        self.most = np.array([x for _, _, x in listed], np.float32)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """The term of every word, -1 for words that no item has."""
        if not len(self.terms):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)

    def pivots(self, terms: np.ndarray, halves: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        """(passage, block) of every block whose bound reaches the threshold.

        `halves` numbers the half passage of each term, up to `count`; passage i is made of the halves i and i + 1. Each
        half counts a term once.
        """
        known = terms >= 0
        pairs = np.unique(halves[known] * np.int64(max(1, len(self.terms))) + terms[known])
        at, which = np.divmod(pairs, max(1, len(self.terms)))
        found, wide = [], max(1, len(self.blocks))
        step = max(1, 4_000_000 // wide)
        for low in range(0, count, step):  # sums of some halves at a time, and of the half after them
            high = min(count, low + step)
            begin, end = np.searchsorted(at, [low, high + 1])
            here, lists = at[begin:end], which[begin:end]
            sizes = self.first[lists + 1] - self.first[lists]
            place = np.repeat(self.first[lists] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            sums = np.bincount(np.repeat(here - low, sizes) * wide + self.block[place], self.most[place], (high - low + 1) * wide).reshape(-1, wide)
            passages, blocks = np.nonzero(sums[:-1] + sums[1:] >= THRESHOLD - 1e-4)
            found.append((passages + low, blocks))
        return tuple(np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))

    def search(self, terms: set[int], block: int) -> list[tuple[int, float]]:
        """(item, score) of the items of a block with a score of THRESHOLD or more."""
        lists = self.blocks[block]
        met = sorted(((max(x for _, x in lists[t]), t) for t in terms & lists.keys()), reverse=True)
        left, scores = sum(x for x, _ in met), {}
        for most, t in met:
            if left < THRESHOLD - 1e-4 and max(scores.values(), default=0.0) + left < THRESHOLD - 1e-4:
                return []
            left -= most
            for item, x in lists[t]:
                scores[item] = scores.get(item, 0.0) + x
        return [(i, s) for i, s in scores.items() if s >= THRESHOLD - 1e-9]

    def hits(self, texts: list[Text]) -> Iterator[tuple[int, int, float, float, float]]:
        """(text, item_id, score, question overlap, answer overlap) of every verified occurrence in any passage."""
        sizes = np.array([len(t.hashes) for t in texts])
        halves = -(-sizes // self.half) + 1  # an empty half keeps the passages of texts apart
        first_word, first_half = np.cumsum(sizes) - sizes, np.cumsum(halves) - halves
        of = np.repeat(np.arange(len(texts)), sizes)
        terms = self.ids(np.concatenate([t.hashes for t in texts]))
        place = (np.arange(len(terms)) - first_word[of]) // self.half + first_half[of]
        passages, blocks = self.pivots(terms, place, int(halves.sum()))
        last, held, span = -1, set(), []
        for passage, block in zip(passages.tolist(), blocks.tolist()):
            text = int(np.searchsorted(first_half, passage, "right")) - 1
            start = (passage - int(first_half[text])) * self.half
            if start >= sizes[text]:
                continue
            if passage != last:
                at = int(first_word[text]) + start
                stop = min(start + 2 * self.half, int(sizes[text]))
                held, last, span = set(terms[at : at + stop - start].tolist()) - {-1}, passage, None
            for item, score in self.search(held, block):
                span = span or texts[text].words(start, stop)
                question, answer = self.items[item].overlaps(span)
                if question >= OVERLAP and answer >= OVERLAP:
                    yield text, self.items[item].item_id, score, question, answer


def _together(texts: Iterator[str]) -> Iterator[list[Text]]:
    """Texts in groups of about TOGETHER words, each whole."""
    group, n = [], 0
    for text in texts:
        group.append(Text(text))
        n += len(group[-1].hashes)
        if n >= TOGETHER:
            yield group
            group, n = [], 0
    if group:
        yield group


_SHAPE = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap): one row per document and item found in it.

    Texts and items that are null or without a word find nothing and are never found. Items may repeat: of rows with
    one item_id each is looked for, and the best counts. Repeated documents give one row. Rows without doc_id or
    item_id are not searched. Other columns are ignored.
    """
    spark = docs.sparkSession
    given = docs.select("doc_id", "text").where("doc_id is not null and text is not null")
    items = items.select("item_id", "text").where("item_id is not null and text is not null")
    count = items.count()
    shards = max(1, -(-count // SHARD_ITEMS))
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)))

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard, text in zip(batch["shard"], batch["text"]):
                hashes = Text(text).hashes
                yield pd.DataFrame({"shard": shard, "term": np.unique(hashes).view(np.int64)})

    terms = pin(dealt.select("shard", "text").mapInPandas(listed, "shard long, term long"), "terms")
    spread = terms.groupBy("term").agg(F.count("*").alias("spread"))
    sizes = dealt.select("text").mapInPandas(lambda batches: (pd.DataFrame({"words": [len(Text(t).hashes) for t in b["text"]]}) for b in batches), "words long")
    whole = sizes.where("words > 0").agg(F.count("*").alias("n"), F.coalesce(F.avg("words"), F.lit(1.0)).alias("mean"), F.coalesce(F.max("words"), F.lit(0)).alias("longest")).first()
    found = None
    for first in range(0, shards, SHARDS_AT_ONCE):
        here = F.col("shard").between(first, first + SHARDS_AT_ONCE - 1)
        rows: dict[int, list] = {}
        for r in dealt.where(here).toLocalIterator():
            rows.setdefault(r.shard, []).append((r.item_id, r.text))
        of = terms.where(here).select("term").distinct().join(spread, "term").toPandas()  # the words of these shards
        order = np.argsort(of["term"].to_numpy(np.int64).view(np.uint64))
        known = Statistics(whole.n, whole.mean, whole.longest, of["term"].to_numpy(np.int64).view(np.uint64)[order], of["spread"].to_numpy(np.int64)[order])
        indexes = spark.sparkContext.broadcast([Index(x, known) for x in rows.values()])  # SHARDS_AT_ONCE * SHARD_ITEMS items

        def search(batches: Iterator[pd.DataFrame], indexes=indexes) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out, ids, done = [], batch["doc_id"].tolist(), 0
                for texts in _together(batch["text"]):
                    for index in indexes.value:
                        out += [(ids[done + x[0]], *x[1:]) for x in index.hits(texts)]
                    done += len(texts)
                yield pd.DataFrame(out, columns=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

        met = given.mapInPandas(search, _SHAPE)
        met = pin(met, "contaminated") if shards > SHARDS_AT_ONCE else met
        found = met if found is None else found.unionAll(met)
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("score", "question_overlap", "answer_overlap")).alias("x"))
    return best.select("doc_id", "item_id", "x.*")


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """`docs` without the documents in which an item was found."""
    return docs.join(contaminated(docs, items).select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def op3_block_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ship(__name__)

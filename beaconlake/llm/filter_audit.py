"""How filters interact: what each removes in every order, what others would have removed, and what each alone finds.

Every document gets a mask of the filters that it fails; which document falls at which step of which order follows from
the mask alone, so all orders are sums over at most 32 counts a part.

The costly filter is the one for repeated texts. A counting Bloom filter goes before it: each text's hash adds one to
`HASHES` counters, counted within tasks and merged by sums. A text with a counter of one is unique in the table and
is cleared without being moved. Only the others, those that may repeat, are grouped by their whole text for the smallest
id, copies within a task first. The filter has 16 counters a document, but 2**`MOST_BITS` at most, which bounds what is
sent out: one bit a counter. Beyond 2**`MOST_BITS` / 16 documents it clears fewer texts, and the result is the same.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.llm.common import WORD, ship, table
from beaconlake.storage import pin

#: A: few words, B: repeated words, C: capitals, D: symbols, E: a smaller doc_id has the same text.
FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
HASHES = 4
COUNTERS = 16
MOST_BITS = 28


def own_mask(text: Column) -> Column:
    """Bits 0 to 3 for the filters that see one text."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    fails = [n < 50, 100 * distinct < 65 * n, 100 * F.regexp_count(text, F.lit("[A-Z]")) > 5 * F.length(text), text.rlike("[#$%&*|]")]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def _positions(of: Column, counters: int) -> list[Column]:
    low, high = of.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(of, 32).bitwiseOR(F.lit(1))
    return [(low + high * i) % counters for i in range(HASHES)]


def counted_twice(hashes: DataFrame, counters: int) -> np.ndarray:
    """Words of 64 bits, one bit per counter that is over one. `hashes` has a bigint column `hash`, one row per text."""
    each = hashes.select(F.explode(F.array(*_positions(F.col("hash"), counters))).alias("at"))
    over = each.groupBy("at").agg(F.count("*").alias("n")).where("n > 1")
    words = over.groupBy(F.shiftright("at", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("bits"))
    got = words.toPandas()  # at most counters / 64 rows
    out = np.zeros(counters // 64, np.int64)
    out[got["word"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64)
    return out.view(np.uint64)


def may_repeat(spark: SparkSession, bits: np.ndarray) -> object:
    """A column function of a text's hash: false only if no other text of the table has the hash."""
    sent = spark.sparkContext.broadcast(bits)

    def test(hashes: pd.Series) -> pd.Series:
        bits, h = sent.value, hashes.to_numpy(np.int64).view(np.uint64)
        low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
        found = np.ones(len(h), bool)
        for i in range(HASHES):
            at = (low + high * np.uint64(i)) % np.uint64(len(bits) * 64)
            found &= (bits[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return pd.Series(found)

    return F.pandas_udf(test, "boolean")


def first_ids(docs: DataFrame, hashes: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """hash, second (both of the text) and the smallest doc_id, for texts that more than one row of `docs` has.

    `docs` has doc_id, text; `hashes` the column `hash` of the same rows. Texts are compared whole. Two texts that agree
    in both hashes raise, as the pair then names no text.
    """
    spark, rows = docs.sparkSession, hashes.count()
    counters = 1 << min(most_bits, max(10, int(np.ceil(np.log2(COUNTERS * max(1, rows))))))
    test = may_repeat(spark, counted_twice(hashes, counters))
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("hash")).where(test("hash"))
    texts = hashed.groupBy("hash", "text").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    named = texts.select("hash", _second(F.col("text")).alias("second"), "first", "n").groupBy("hash", "second")
    one = named.agg(F.min("first").alias("first"), F.sum("n").alias("n"), F.count("*").alias("texts"))
    clash = F.raise_error(F.lit("two texts have equal hashes")).cast("bigint")
    return one.where("n > 1").select("hash", "second", F.when(F.col("texts") == 1, F.col("first")).otherwise(clash).alias("first"))


def _second(text: Column) -> Column:
    return F.xxhash64(F.lit(1), text)


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents of each part by the filters that they fail, at most 32 rows a part."""
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    own = rows.select("doc_id", "part", own_mask(F.col("text")).alias("own"), F.xxhash64("text").alias("hash"), _second(F.col("text")).alias("second"))
    own = pin(own, "masks")
    first = first_ids(rows.select("doc_id", "text"), own.select("hash"))
    yes = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("long")).alias(c)
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(yes("quality"), yes("toxic"))
    told = own.join(first, ["hash", "second"], "left").select(
        "doc_id", "part", (F.col("own") + F.when(F.col("doc_id") > F.col("first"), 1 << 4).otherwise(0)).alias("mask")
    )
    told = told.join(known, "doc_id", "left")
    sums = (F.sum(F.coalesce(c, F.lit(0))).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic")))
    return told.groupBy("part", "mask").agg(F.count("*").alias("n"), *sums)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    One row per part, order of the five filters and step, zeros included; a part is a source, null and empty ones
    together. Null texts are empty. A row without doc_id is no one's earlier copy and repeats none; rows of one doc_id
    and text are not copies of each other but of smaller ids. Repeated rows count as often as they came. Of several
    labels of a doc_id any 1 counts; labels without a document don't. Without documents there is no part and no row.
    Other columns are ignored.
    """
    per = masks(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("m"))  # at most 32 a part
    rows = per.select("part", "m", F.explode(F.array(*map(F.lit, ORDERS))).alias("filter_order"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    bit = lambda i: f"shiftleft(1, ascii(substring(filter_order, {i}, 1)) - {ord(FILTERS[0])})"
    rows = rows.withColumn("bit", F.expr(bit("step"))).withColumn("before", F.expr(f"aggregate(filter(sequence(1, 5), i -> i < step), 0, (a, i) -> a | {bit('i')})"))
    total = lambda of, where: F.expr(f"aggregate(filter(m, x -> {where}), 0L, (a, x) -> a + {of})")
    fails, reached = "(x.mask & bit) <> 0", "(x.mask & before) = 0"
    return rows.select(
        "part", "filter_order", "step",
        total("x.n", f"{reached} and not ({fails})").alias("kept"),
        total("x.n", f"{reached} and {fails}").alias("removed"),
        total("x.n", f"not ({reached}) and {fails}").alias("redundant"),
        total("x.n", "x.mask = bit").alias("unique_fails"),
        total("x.good", f"{reached} and {fails}").alias("good_lost"),
        total("x.toxic", f"{reached} and {fails}").alias("toxic_lost"),
        # of a mask of k filters, each comes first of them in one order of k
        total(f"x.n * ({len(ORDERS)} div bit_count(x.mask))", fails).alias("shapley"),
    )


def op12_counting_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL = f"""
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents
), f AS (
  SELECT t.doc_id, part, CASE WHEN len(words) < 50 THEN 1 ELSE 0 END AS a, CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 1 ELSE 0 END AS b,
    CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text) THEN 1 ELSE 0 END AS c,
    CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 1 ELSE 0 END AS d,
    CASE WHEN t.doc_id > min(t.doc_id) OVER (PARTITION BY text) THEN 1 ELSE 0 END AS e, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM t LEFT JOIN (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id) l ON t.doc_id = l.doc_id
), g AS (
  SELECT part, a, b, c, d, e, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL
), letters(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')), orders AS (
  SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM letters p, letters q, letters r, letters s, letters t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
), steps AS (SELECT filter_order, step, substr(filter_order, step, 1) AS own FROM orders, range(1, 6) AS _(step)
), h AS (
  SELECT part, filter_order, step, own, n, good, toxic, a + b + c + d + e AS fails,
    CASE own WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END AS hit,
    CASE WHEN a * strpos(filter_order, 'A') BETWEEN 1 AND step - 1 OR b * strpos(filter_order, 'B') BETWEEN 1 AND step - 1
      OR c * strpos(filter_order, 'C') BETWEEN 1 AND step - 1 OR d * strpos(filter_order, 'D') BETWEEN 1 AND step - 1
      OR e * strpos(filter_order, 'E') BETWEEN 1 AND step - 1 THEN 1 ELSE 0 END AS gone
  FROM g, steps
), s AS (
  SELECT part, filter_order, step, own, sum(n * (1 - gone) * (1 - hit)) AS kept, sum(n * (1 - gone) * hit) AS removed, sum(n * gone * hit) AS redundant,
    sum(CASE WHEN hit = 1 AND fails = 1 THEN n ELSE 0 END) AS unique_fails, sum(good * (1 - gone) * hit) AS good_lost, sum(toxic * (1 - gone) * hit) AS toxic_lost
  FROM h GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM s
"""

ship(__name__)

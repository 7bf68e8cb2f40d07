"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A document is a weighted set: its terms are its words, lower-cased, and a term's weight is how often it occurs. For each
of `SAMPLES` samples every term k draws, from its own hash alone, r and c from Gamma(2, 1) and b from (0, 1]. With
weight w it gets t = floor(ln w / r + b), y = exp(r * (t - b)) and a = c / (y * exp(r)); the sample is the term of least
a, with its t. Two documents take the same sample with a probability equal to the generalised Jaccard similarity of
their weights, sum of min(w, w') over sum of max(w, w').

Samples are worked out `AT_ONCE` at a time, a row of a term each: the code of all in one row would be too long for the JVM
to compile, which costs four times as much. Logarithms, which Spark takes by a native call each, come from two tables of one
broadcast row; as constants in the expressions every look-up would have a copy of its table.

a is fixed by k and t, and other terms and t give another ln a of 32 bits but for a chance of 2**-20 or so. So the least
ln a itself names the sample, which makes a signature a plain grouped minimum of floats: combined where the rows are, no
row per term leaves its task, and a document of any length is one group of rows that one task streams. A document and
its edited text share the draws of the terms that both have.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from beaconlake.llm.common import table
from beaconlake.storage import pin

SAMPLES = 64
#: Samples are named in the fingerprint by so many hexadecimal digits each.
DIGITS = 8
#: Samples of a row of a term.
AT_ONCE = 8
#: Cells of the look-up tables, and how many of the lowest are worked out instead.
CELLS, SERIES = 2048, 32
TABLES = ("minus_ln", "ln_gamma")
#: Documents that follow each other by id are taken together, so many at most.
BLOCK = 16_384


def _quantile(u: float) -> float:
    """The value up to which Gamma(2, 1) has the probability u: 1 - (1 + x) exp(-x) = u."""
    low, high = 0.0, 60.0
    for _ in range(60):
        x = (low + high) / 2
        low, high = (x, high) if 1 - (1 + x) * math.exp(-x) < u else (low, x)
    return (low + high) / 2


def _tables(spark: SparkSession) -> DataFrame:
    """One row: `minus_ln`, -ln of the middle of each of CELLS cells of (0, 1); `ln_gamma`, at each cell's border the
    logarithm of Gamma(2, 1)'s quantile, at 1 that of the largest draw."""
    borders = [max(k, 0.5) / CELLS for k in range(CELLS)] + [1 - 2.0**-29]
    row = ([-math.log((k + 0.5) / CELLS) for k in range(CELLS)], [math.log(_quantile(u)) for u in borders])
    kind = ArrayType(DoubleType(), False)
    return spark.createDataFrame([row], StructType([StructField(name, kind, False) for name in TABLES]))


def _log_c(bits: Column) -> Column:
    """ln of a Gamma(2, 1) draw from 28 bits: between the borders of a cell in proportion, off by less than 0.001 below the
    quantile of 0.996; in the lowest cells, which decide in long documents, by the series of the quantile in s = sqrt(2 u)."""
    cell = F.shiftrightunsigned(bits, 17).cast("int")
    inside = (bits.bitwiseAND((1 << 17) - 1) + F.lit(0.5)) * F.lit(2.0**-17)
    s = F.sqrt((cell + inside) * F.lit(2 / CELLS))
    low, high = F.col("ln_gamma")[cell], F.col("ln_gamma")[cell + 1]
    series = F.ln(s) + s * (F.lit(1 / 3) + s * (F.lit(7 / 72) + s * (F.lit(0.041) + s * F.lit(0.0225))))
    return F.when(cell < SERIES, series).otherwise(low + (high - low) * inside)


def _log_a(i: Column, weights: list[str]) -> list[Column]:
    """ln a of sample i for a term of hash `h`, for each column of ln weights; infinite without a weight.

    One hash gives all draws: r, the sum of -ln of two uniforms, from two of 11 bits, c from 28 and b from 14.
    """
    bits = F.xxhash64("h", i)
    draw = lambda shift, width: F.shiftrightunsigned(bits, shift).bitwiseAND((1 << width) - 1)
    r = F.col("minus_ln")[draw(0, 11).cast("int")] + F.col("minus_ln")[draw(11, 11).cast("int")]
    log_c = _log_c(draw(22, 28))
    b = (draw(50, 14) + F.lit(0.5)) * F.lit(2.0**-14)
    log_a = [(log_c - r * (F.floor(F.col(w) / r + b) - b + 1)).cast("float") for w in weights]
    return [F.coalesce(a, F.lit(math.inf).cast("float")) for a in log_a]


def _hashes(text: str, side: int) -> Column:
    """Hashes of a text's words, with the side in the last bit."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), "")
    if side:
        return F.transform(words, lambda w: F.xxhash64(w).bitwiseOR(F.lit(1)))
    return F.transform(words, lambda w: F.shiftleft(F.shiftright(F.xxhash64(w), 1), 1))


def signatures(rows: DataFrame, keys: list[str], kept: list[str] | None = None, samples: int = SAMPLES, texts: tuple[str, ...] = ("text",)) -> DataFrame:
    """`keys`, the largest of each bigint column in `kept`, and of each of one or two text columns its signature.

    A signature is an array of floats, NULL for a text without a word, named `signature` and `edited_signature`. Rows of
    equal keys count as one document with all their terms, each of the largest weight that it has in one row.
    """
    kept = kept or []
    carried = [*keys, *kept]
    sides = [_hashes(t, i) for i, t in enumerate(texts)]
    # Sorted, equal hashes of either side are a run, and the two runs of a word are neighbours. A document without a word
    # has a single run of no hash, which weighs nothing.
    sorted_ = rows.select(*carried, F.sort_array(F.concat(*sides)).alias("w"))
    runs = sorted_.select(*carried, "w", F.expr("filter(sequence(0, size(w) - 1), i -> i = 0 or get(w, i) <> get(w, i - 1))").alias("s"))
    runs = runs.crossJoin(F.broadcast(_tables(rows.sparkSession)))
    # Nothing from here on holds a lambda, so all is compiled; a generator that isn't copies its row's arrays for every term.
    # The outer form, as for the inner one the optimizer would work out the arrays twice, to leave out empty ones early.
    places = runs.select(*carried, "w", "s", *TABLES, F.explode_outer(F.expr("sequence(0, size(s) - 1)")).alias("j"))
    terms = places.where("j = 0 or shiftright(get(w, get(s, j)), 1) <> shiftright(get(w, get(s, j - 1)), 1)")
    first = F.expr("coalesce(get(s, j + 1), size(w)) - get(s, j)")
    second = F.expr("case when shiftright(get(w, get(s, j + 1)), 1) = shiftright(get(w, get(s, j)), 1) then coalesce(get(s, j + 2), size(w)) - get(s, j + 1) end")
    odd = F.expr("(get(w, get(s, j)) & 1) = 1")
    counts = {"own": F.when(~odd, first), "edited": F.when(odd, first).otherwise(second)}
    names = list(counts)[: len(texts)]
    terms = terms.select(*carried, *TABLES, F.expr("shiftright(get(w, get(s, j)), 1)").alias("h"), *(F.ln(counts[n].cast("double")).alias(n) for n in names))
    groups = -(-samples // AT_ONCE)
    parts = terms.select("*", F.explode(F.array(*map(F.lit, range(groups)))).alias("part"))
    draws = [_log_a(F.col("part") * AT_ONCE + i, names) for i in range(AT_ONCE)]
    least = parts.groupBy(*keys, "part").agg(
        *(F.max(c).alias(c) for c in kept), *(F.min(draws[i][k]).alias(f"{n}{i}") for k, n in enumerate(names) for i in range(AT_ONCE))
    )
    whole = least.groupBy(*keys).agg(
        *(F.max(c).alias(c) for c in kept),
        F.array_sort(F.collect_list(F.struct("part", *(F.array(*(f"{n}{i}" for i in range(AT_ONCE))).alias(n) for n in names)))).alias("parts"),  # one a part
    )
    made = {"own": "signature", "edited": "edited_signature"}

    def signature(side: str) -> Column:
        all_ = F.slice(F.flatten(F.transform("parts", lambda p: p[side])), 1, samples)
        return F.when(all_[0] < math.inf, all_).alias(made[side])

    return whole.select(*carried, *(signature(n) for n in names))


def fingerprint(signature: Column) -> Column:
    """The signature as text, DIGITS hexadecimal digits a sample; of a document without a word, the empty text."""
    digits = F.transform(signature, lambda a: F.lower(F.right(F.hex(F.xxhash64(a)), F.lit(DIGITS))))
    return F.coalesce(F.array_join(digits, ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples; 1 for two documents without a word, 0 if just one has none."""
    equal = F.size(F.filter(F.arrays_zip(a.alias("x"), b.alias("y")), lambda p: p["x"] == p["y"])) / F.size(a)
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(equal)


def following(ids: DataFrame) -> DataFrame:
    """(doc_id, next_id): after each id the next smaller one, after the smallest the largest. `ids` are distinct.

    The ids are dealt out by range and followed within each part; only the parts' ends, one row a part, are put in
    order together.
    """
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pin(ids.select("doc_id").repartitionByRange(parts, "doc_id").withColumn("part", F.spark_partition_id()), "ids")
    ends = dealt.groupBy("part").agg(F.max("doc_id").alias("top"))
    before = ends.select("part", F.lag("top").over(Window.orderBy("part")).alias("below"), F.max("top").over(Window.partitionBy(F.lit(0))).alias("first"))
    inside = F.lead("doc_id").over(Window.partitionBy("part").orderBy(F.desc("doc_id")))
    led = dealt.withColumn("lead", inside).join(F.broadcast(before), "part")
    return led.select("doc_id", F.coalesce("lead", "below", "first").alias("next_id"))


def _block_bits(ids: DataFrame, most: int) -> int:
    """How many low bits of an id are left out to name its block, so that no block has over `most` rows if that can be."""
    size = ids.agg(F.count("*").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    if not size.n:
        return 0
    bits = max(0, min(62, int(math.log2(max(1.0, (size.high - size.low + 1) / size.n * most / 8)))))
    while bits:
        largest = ids.groupBy(F.shiftright("doc_id", bits).alias("block")).count().agg(F.max("count")).first()[0]
        if largest <= most:
            break
        bits = max(0, bits - 2)
    return bits


def _as_longs(sha: Column) -> list[Column]:
    """A SHA-256 in hexadecimal as four bigints, which a grouped maximum can carry without sorting."""
    return [F.conv(F.substring(sha, 16 * i + 1, 16), 16, -10).cast("long") for i in range(4)]


def _as_sha(parts: list[str]) -> Column:
    return F.concat(*(F.lower(F.lpad(F.hex(p), 16, "0")) for p in parts))


def _met(column: str, order) -> Column:
    """Of the document that comes next, what the row has that others meet; the rows of one document are neighbours."""
    value = f"case when least then {column} end"
    return F.expr(f"lead({value}) ignore nulls").over(order)


def fingerprints(docs: DataFrame, samples: int = SAMPLES, block: int = BLOCK) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row of `docs`.

    A null text counts as empty; the fingerprint of a text without a word is empty. The next document has the next
    smaller doc_id, after the smallest the largest; where rows repeat a doc_id with different texts, the least text is
    the one that others meet as next. A row without doc_id has no next document: its edited text is its first half, and
    the next document counts as empty. Repeated rows come back as often as they came; other columns are ignored.

    Texts are shuffled once, to blocks of neighbouring ids. Where a block ends it gets a copy of the document that comes
    next, the first one of another block, so that everything else happens within blocks: one text a block moves twice.
    """
    every = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("row", F.monotonically_increasing_id())
    placed, lost = every.where("doc_id is not null"), every.where("doc_id is null")
    ids = placed.select("doc_id")
    bits = _block_bits(ids, block)
    repeated = not ids.groupBy("doc_id").count().where("count > 1").limit(1).isEmpty()
    at = F.shiftright("doc_id", bits)
    tops = pin(ids.groupBy(at.alias("block")).agg(F.max("doc_id").alias("doc_id")), "blocks")
    # written, so that its size is known: one row a block
    after = pin(following(tops).join(tops, "doc_id").select(F.col("next_id").alias("doc_id"), "block"), "borders")
    borders = after.join(placed, "doc_id").groupBy("block").agg(F.min("text").alias("text"))
    no_id, no_block = F.lit(None).cast("long"), F.pmod(F.xxhash64("row"), F.lit(1024))
    columns = ["kind", "block", "doc_id", "row", "text"]
    rows = placed.select(F.lit(0).alias("kind"), at.alias("block"), "doc_id", "row", "text").unionByName(
        borders.select(F.lit(1).alias("kind"), "block", no_id.alias("doc_id"), F.lit(0).cast("long").alias("row"), "text")
    ).unionByName(lost.select(F.lit(2).alias("kind"), no_block.alias("block"), "doc_id", "row", "text"))
    # rows without an id have blocks of their own: kind 2 shares a block's task, never its order
    rows = rows.select((F.col("kind") == 2).alias("lost"), *columns).repartition("block", "lost")
    group = Window.partitionBy("block", "lost")
    least = F.lit(True)
    if repeated:
        least = F.row_number().over(Window.partitionBy("block", "lost", "kind", "doc_id").orderBy("text", "row")) == 1
    rows = rows.withColumn("least", least | (F.col("kind") > 0))
    order = group.orderBy("kind", F.desc("doc_id"), F.desc("least"), "row")
    rows = rows.withColumn("head", F.coalesce(F.when(~F.col("lost"), _met("text", order)), F.lit("")))
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring(F.col("head"), F.lit(1), half))
    rows = rows.withColumn("edited", edited)
    longs = _as_longs(F.sha2(F.col("edited").cast("binary"), 256))
    kept = ["n_chars", *(f"s{i}" for i in range(4))]
    keys = ["block", "lost", "kind", "doc_id", "least", "row"]
    rows = rows.select(*keys, "text", "edited", "n_chars", *(c.alias(f"s{i}") for i, c in enumerate(longs)))
    signed = signatures(rows, keys, kept, samples, ("text", "edited"))
    # a document without a word still has a signature to be met, if an empty one
    own = F.coalesce("signature", F.array().cast("array<float>"))
    signed = signed.withColumn("own", own)
    signed = signed.withColumn("after", F.when(~F.col("lost"), _met("own", order))).where("kind <> 1")
    signed = signed.withColumn("after", F.when(F.size("after") > 0, F.col("after")))
    return signed.select(
        "doc_id", "n_chars", _as_sha([f"s{i}" for i in range(4)]).alias("edited_sha256"),
        fingerprint(F.col("signature")).alias("fingerprint"), fingerprint(F.col("edited_signature")).alias("edited_fingerprint"),
        likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        likeness(F.col("signature"), F.col("after")).alias("near_next"),
    )


def op8_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))

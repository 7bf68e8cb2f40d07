"""Near-duplicate documents: SimHash fingerprints linked by a pigeonring index.

A fingerprint is a ring of 16 segments of 4 bits. If two fingerprints differ in at most 3 bits, some segment starts a
chain whose first l segments differ in at most 3 * l / 16 bits for every l: 0 in the first five, 1 in ten, 2 in fifteen.
So from that start five segments agree and, of the next five, the first two or the last three agree as well. These
two keys of 28 and 32 bits for each of 16 starts are the index; pairs that meet under a key pass the chain's budgets at
10 and 15 segments before the whole distance is counted.

Fingerprints are taken once each, whatever the number of their documents. A key under which more than `RUN` of them
meet is not compared but divided: its free bits fall into four parts, and as 3 bits differ at most, one part agrees,
which gives four finer keys. Eight free bits leave at most 256 fingerprints, so that the division always ends, without
a link being lost. Within a key only a spanning forest of the links is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from beaconlake.llm.common import components, packed, ship, table
from beaconlake.storage import pin

SEED = 42
BITS = 3
SEGMENTS, WIDTH = 16, 4
RUN = 256
_SHAPE = "edge boolean, key long, mask long, fp long, rep long"


def fingerprint_of(text: str | None, words: int = 3, seed: int = SEED) -> int:
    """The unsigned SimHash of a text: a bit is set if over half of the shingles' hashes have it; 0 without a word."""
    found = (text or "").encode("utf-8", "replace").lower().split()  # of bytes both act on ASCII alone
    if not found:
        return 0
    parts = [found[i:] for i in range(words)] if len(found) >= words else [[x] for x in found]
    hashed = np.fromiter((xxhash.xxh64_intdigest(b" ".join(x), seed) for x in zip(*parts)), np.uint64)
    ones = np.zeros(64, np.int64)
    for part in np.array_split(hashed, len(hashed) // 65536 + 1):
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashed), bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text: str = "text", to: str = "fp", words: int = 3) -> DataFrame:
    """`docs` with the SimHash of its text as a signed bigint."""

    def hashes(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint_of(x, words) for x in texts], np.uint64).view(np.int64))

    return docs.withColumn(to, F.pandas_udf(hashes, "long")(text))


def _rotated(i: int):
    return F.col("fp") if i == 0 else F.shiftleft("fp", WIDTH * i).bitwiseOR(F.shiftrightunsigned("fp", 64 - WIDTH * i))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _turned(x: int, by: int) -> int:
    return ((x >> by) | (x << (64 - by))) & (1 << 64) - 1 if by else x


#: Of a fingerprint turned to its start: the bits of a chain's first 10 and 15 segments, and those of the two keys.
_TEN, _FIFTEEN = ((1 << 40) - 1) << 24, ((1 << 60) - 1) << 4
_KEY_BITS = ((1 << 28) - 1) << 36, ((1 << 20) - 1) << 44 | ((1 << 12) - 1) << 24


def _keys(reps: DataFrame) -> DataFrame:
    """One row per fingerprint, start and half: key, mask of the bits the key fixes, fingerprint, representative."""
    made = []
    for i in range(SEGMENTS):
        turned = _rotated(i)
        near = F.shiftrightunsigned(turned, 36)
        far = F.shiftleft(F.shiftrightunsigned(turned, 44), 12).bitwiseOR(F.shiftrightunsigned(turned, 24).bitwiseAND(4095))
        for half, value in enumerate((near, far)):
            tag = (2 * i + half) << 40
            mask = F.lit(_signed(_turned(_KEY_BITS[half], WIDTH * i)))
            made.append(F.struct(value.bitwiseOR(F.lit(tag)).alias("key"), mask.alias("mask")))
    return reps.select(F.explode(F.array(*made)).alias("at"), "fp", "rep").select("at.key", "at.mask", "fp", "rep")


def _forest(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Which of the links (a, b) a spanning forest keeps."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    kept = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = top(x), top(y)
        if x != y:
            up[max(x, y)] = min(x, y)
            kept.append(i)
    return kept


def _links(run: pd.DataFrame, chains: bool) -> pd.DataFrame:
    """Links among rows sorted by key, of which equal keys are at most RUN; `chains`: keys are those of a chain's start."""
    key, fp, rep = run["key"].to_numpy(), run["fp"].to_numpy().view(np.uint64), run["rep"].to_numpy()
    at = np.arange(len(key))
    found = []
    for step in range(1, RUN):
        at = at[at + step < len(key)]
        at = at[key[at] == key[at + step]]
        if not len(at):
            break
        apart = fp[at] ^ fp[at + step]
        if chains:
            turn = ((key[at] >> 41) * WIDTH).astype(np.uint64)
            ring = (apart << turn) | np.where(turn > 0, apart >> ((np.uint64(64) - turn) % np.uint64(64)), np.uint64(0))
            viable = np.bitwise_count(ring & np.uint64(_TEN)) <= 1
            viable[viable] = np.bitwise_count(ring[viable] & np.uint64(_FIFTEEN)) <= 2
            viable[viable] = np.bitwise_count(ring[viable]) <= BITS
        else:
            viable = np.bitwise_count(apart) <= BITS
        found.append(np.stack([key[at][viable], rep[at][viable], rep[at + step][viable]]))
    if not found or not sum(x.shape[1] for x in found):
        return pd.DataFrame({"fp": np.zeros(0, np.int64), "rep": np.zeros(0, np.int64)})
    _, a, b = np.concatenate(found, axis=1)
    kept = _forest(a, b)
    return pd.DataFrame({"fp": a[kept], "rep": b[kept]})


def _finer(rows: pd.DataFrame) -> pd.DataFrame:
    """Four rows for each row of a key that too many share, one per part of its free bits."""
    fixed = int(np.uint64(rows["mask"].iloc[0].astype(np.int64).view(np.uint64)))
    free = [b for b in range(64) if not fixed >> b & 1]
    fp, made = rows["fp"].to_numpy().view(np.uint64), []
    for part in np.array_split(free, BITS + 1):
        mask = fixed | sum(1 << int(b) for b in part)
        tag = xxhash.xxh64_intdigest(mask.to_bytes(8, "little"), SEED)
        mixed = (fp & np.uint64(mask)) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(tag)
        made.append(rows.assign(key=mixed.view(np.int64), mask=_signed(mask)))
    return pd.concat(made)


def _compare(chains: bool):
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest, hot = None, None

        def told(rows: pd.DataFrame, edge: bool) -> pd.DataFrame:
            return rows.assign(edge=edge).reindex(columns=["edge", "key", "mask", "fp", "rep"], fill_value=0)

        for batch in batches:
            if not len(batch):
                continue
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            key = rows["key"].to_numpy()
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            sizes = np.diff(np.r_[starts, len(key)])
            sizes = np.repeat(sizes, sizes)
            last = starts[-1]
            crowded = (sizes > RUN) | (key == hot if hot is not None else False)
            cold = ~crowded
            cold[last:] = False
            found = _links(rows[cold], chains)
            if len(found):
                yield told(found, True)
            for _, same in rows[crowded].groupby(["key", "mask"], sort=False):
                yield told(_finer(same), False)
            hot = key[last] if crowded[last] else None
            rest = None if crowded[last] else rows.iloc[last:]
        if rest is not None:
            found = _links(rest, chains)
            if len(found):
                yield told(found, True)

    return compare


def near_links(reps: DataFrame) -> DataFrame:
    """Links (a, b) that connect all fingerprints of `reps` (fp, rep; fp distinct) at 3 or fewer differing bits."""
    rows, edges, chains = _keys(reps.where("rep is not null")), None, True
    while True:
        met = rows.repartition("key").sortWithinPartitions("key").mapInPandas(_compare(chains), _SHAPE)
        met = pin(met, "near")
        found = met.where("edge").select(F.col("fp").alias("a"), F.col("rep").alias("b"))
        edges = found if edges is None else edges.unionAll(found)
        rows, chains = met.where("not edge").select("key", "mask", "fp", "rep"), False
        if rows.isEmpty():
            return edges


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits) and component_id, one row per row of `docs` (doc_id, text).

    Texts without a word, null ones among them, have fingerprint zero and are linked like any other. Ties take the
    smallest doc_id. Repeated rows come back as often as they came. A row without doc_id gets the component of its
    fingerprint, null if no row with a doc_id has it. An empty table gives an empty result; other columns are ignored.
    """
    fps = pin(with_fingerprint(docs.select("doc_id", "text")).select("doc_id", "fp"), "fingerprints")
    reps = pin(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "representatives")
    roots = components(near_links(reps))
    named = reps.join(roots, F.col("rep") == F.col("node"), "left").select("fp", F.coalesce("root", "rep").alias("component_id"))
    return fps.join(named, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """`docs` with one row of each component of linked fingerprints, and every column as it was.

    The row with the smallest doc_id stays, of equal ones that whose text has the least hash, and of rows equal in both one;
    a row without doc_id stays only if no row of its component has one. What decides is a row's own fingerprint, so
    that a text that is no one's duplicate stays even if its doc_id also names one that is. Only ids and hashes meet.
    """
    rows = packed(docs, "doc_id", "text")
    text = F.xxhash64(F.coalesce("text", F.lit("")))
    slim = with_fingerprint(rows.select("doc_id", text.alias("hash"), "text")).select("doc_id", "hash", "fp")
    slim = pin(slim, "fingerprints")
    fps = pin(slim.select("fp").distinct(), "representatives")
    roots = components(near_links(fps.select("fp", F.col("fp").alias("rep"))))
    named = fps.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("component"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")
    first = slim.join(named, "fp").groupBy("component").agg(F.min(order).alias("first")).select("first.doc_id", "first.hash")
    first = first.select(F.col("doc_id").alias("first_id"), F.col("hash").alias("first_hash")).distinct()
    keyed = rows.select("row", "doc_id", text.alias("hash"))
    kept = keyed.join(first, F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("hash") == F.col("first_hash")), "left_semi")
    again = kept.groupBy("doc_id", "hash").count().where("count > 1").limit(1)
    if not again.isEmpty():  # equal rows, of which one is enough
        once = Window.partitionBy("doc_id", "hash").orderBy(F.xxhash64("row"))
        kept = kept.withColumn("place", F.row_number().over(once)).where("place = 1")
    return kept.select("row.*")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


ship(__name__)

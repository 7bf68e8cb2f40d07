"""Token counts kept up by signed deltas.

Totals of documents, tokens and characters by source, language and tokenizer version are sums, so they can follow the
corpus without counting it again: a new document adds its counts, a deleted one subtracts them, and a revised one does
both. A batch of changes is summed by key before it is written, signs included, so that its size is that of the totals.

A batch has an id. It is written beside its place and moved there when complete; a batch whose place is taken was
committed before and changes nothing, so that a failed or repeated run can simply be run again. Totals are the sum over
all batches; `compact` folds those so far into one and remembers their ids.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.llm.common import WORD, table
from beaconlake.storage import scratch_path

KEYS = ["source", "lang", "tokenizer"]
SUMS = ["docs", "tokens", "chars"]
#: Tokenizer versions that are plain patterns: words between white space; runs of letters, of digits, single other signs.
PATTERNS = {"words-1": WORD, "pieces-1": r"\p{L}+|\p{N}+|[^\p{L}\p{N}\x20\x09-\x0D]"}
_SHAPE = "source string, lang string, tokenizer string, docs long, tokens long, chars long"


def counts(docs: DataFrame, patterns: dict[str, str] | None = None) -> DataFrame:
    """doc_id, source, lang, tokenizer, tokens, chars: one row per row of `docs` and tokenizer. A null text counts 0."""
    text = F.coalesce("text", F.lit(""))
    each = F.explode(F.array(*(
        F.struct(F.lit(name).alias("tokenizer"), F.regexp_count(text, F.lit(p)).cast("long").alias("tokens"))
        for name, p in (patterns or PATTERNS).items()
    )))
    rows = docs.select("doc_id", "source", "lang", F.length(text).cast("long").alias("chars"), each.alias("t"))
    return rows.select("doc_id", "source", "lang", "t.tokenizer", "t.tokens", "chars")


def signed(rows: DataFrame, sign: int) -> DataFrame:
    """Deltas of `counts` rows: what they add (sign 1) or take away (sign -1)."""
    return rows.select(*KEYS, F.lit(sign).cast("long").alias("docs"), *((F.col(c) * sign).alias(c) for c in SUMS[1:]))


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """The deltas that lead from the counts `before` to those `after`: deletes, inserts, and both for revised rows.

    Equal rows on both sides cancel; no row has to be matched with its successor.
    """
    return signed(before, -1).unionByName(signed(after, 1))


def _rolled(deltas: DataFrame) -> DataFrame:
    return deltas.groupBy(*KEYS).agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in SUMS))


class Rollup:
    """Totals under a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._store = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())
        self._store.mkdirs(self._path(self.folder))

    def _names(self) -> list[str]:
        return sorted(f.getPath().getName() for f in self._store.listStatus(self._path(self.folder)) if f.isDirectory())

    def batches(self) -> list[str]:
        """Ids of all committed batches."""
        names = self._names()
        folded = [x for n in names if n.startswith("folded-") for x in self._ids(n)]
        return sorted({*folded, *(n.removeprefix("batch-") for n in names if n.startswith("batch-"))})

    def _ids(self, name: str) -> list[str]:
        return [r.id for r in self.spark.read.schema("id string").parquet(f"{self.folder}/{name}/ids").collect()]

    def _live(self) -> list[str]:
        """Folders that count: the newest fold, and the batches it does not hold."""
        names = self._names()
        folds = [n for n in names if n.startswith("folded-")]
        held = set(self._ids(folds[-1])) if folds else set()
        return folds[-1:] + [n for n in names if n.startswith("batch-") and n.removeprefix("batch-") not in held]

    def _place(self, name: str, tables: dict[str, DataFrame]) -> bool:
        """Writes a folder that appears as a whole or not at all; False if it was there already."""
        part = f"{self.folder}/_part-{uuid.uuid4().hex}"
        for sub, rows in tables.items():
            rows.write.parquet(f"{part}/{sub}")
        to = self._path(f"{self.folder}/{name}")
        if not self._store.exists(to) and self._store.rename(self._path(part), to):
            return True
        self._store.delete(self._path(part), True)
        return False

    def commit(self, batch: str, deltas: DataFrame) -> bool:
        """Adds a batch of deltas once; False, without reading it, if the batch was committed before."""
        if not re.fullmatch(r"[\w.-]+", batch):
            raise ValueError(f"a batch id has letters, digits, '_', '.' and '-': {batch!r}")
        if batch in self.batches():
            return False
        return self._place(f"batch-{batch}", {"rows": _rolled(deltas)})

    def compact(self) -> None:
        """Folds all batches into one folder. Their own folders stay until nothing reads them and may then be removed."""
        ids, live = self.batches(), self._live()
        names = self.spark.createDataFrame([(i,) for i in ids], "id string")
        number = 1 + max([int(n.split("-")[1]) for n in self._names() if n.startswith("folded-")], default=0)
        self._place(f"folded-{number:08d}", {"rows": _rolled(self._rows(live)), "ids": names})

    def _rows(self, names: list[str]) -> DataFrame:
        paths = [f"{self.folder}/{n}/rows" for n in names]
        reader = self.spark.read.schema(_SHAPE)
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], _SHAPE)

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, docs, tokens, chars; keys whose documents have all gone are left out."""
        rolled = _rolled(self._rows(self._live()))
        return rolled.where(" or ".join(f"{c} <> 0" for c in SUMS))


def op7_delta_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after three batches: all documents come in, every seventh goes, every fifth of the rest is revised to its
    text with line breaks written as ' | '. The first batch is sent twice."""
    docs = table(spark, sf_dir, "documents")
    rollup = Rollup(spark, scratch_path(spark, "rollup"))
    rollup.commit("insert", signed(counts(docs), 1))
    rollup.commit("delete", signed(counts(docs.where("doc_id % 7 = 0")), -1))
    revised = docs.where("doc_id % 7 <> 0 and doc_id % 5 = 0")
    after = revised.withColumn("text", F.replace("text", F.lit("\n"), F.lit(" | ")))
    rollup.commit("revise", changes(counts(revised), counts(after)))
    rollup.commit("insert", signed(counts(docs), 1))
    return rollup.totals()


SQL = """
WITH now AS (
  SELECT source, lang, CASE WHEN doc_id % 5 = 0 THEN replace(coalesce(text, ''), chr(10), ' | ') ELSE coalesce(text, '') END AS text
  FROM documents WHERE doc_id % 7 <> 0 OR doc_id IS NULL
), each AS (
  SELECT source, lang, 'words-1' AS tokenizer, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS tokens, length(text) AS chars FROM now
  UNION ALL
  SELECT source, lang, 'pieces-1', len(regexp_extract_all(text, '\\p{L}+|\\p{N}+|[^\\p{L}\\p{N}\\x20\\x09-\\x0D]')), length(text) FROM now
)
SELECT source, lang, tokenizer, count(*) AS docs, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(sum(chars) AS BIGINT) AS chars
FROM each GROUP BY source, lang, tokenizer
"""

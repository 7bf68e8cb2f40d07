"""Main text of web pages by differencing pages of near URLs.

Pages of one site share their furniture. Each page's text is cut into lines, one per block element, and aligned by longest
common subsequence with the page of its host whose URL path comes next to it in order; the lines that both have, in
the same order, are taken out. What the markup itself declares to be furniture (navigation, footers, forms, adverts and
the like, by tag, role or a class whose whole name says so) does not count as text in the first place; a class that merely
holds such a word says nothing. All other lines are compared, inside and outside of what is declared
to be the article; if one inside is shared, the declaration decides, and it stays. <main> is the place of the article and
whatever stands around it, and declares nothing about a line.

Pages of a host with equal lines are one page here: the neighbour is the next different one, and what goes from one copy
goes from all. A neighbour that has every line of the page is a longer copy, which says nothing about furniture; then the
neighbour on the other side is asked. If each shares over `_COPY` of the page's characters, it may be an edited copy or a
page of little text, and only those shared lines go that most different pages of the host have.

Only line hashes travel between pages. They are put in order by host and path over all tasks, so that a host with a third
of all pages is spread like any other rows; each part hands its first and last page to its neighbours.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from beaconlake.llm.common import ship, table
from beaconlake.storage import pin

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][\w:-]*)((?:[^"'>]++|"[^"]*+"|'[^']*+')*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|itemprop|style|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

_RAW = frozenset("script style textarea title noscript template iframe svg object select".split())
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_FURNITURE = frozenset("nav footer aside form header menu dialog button head".split())
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hr html li main nav ol option p pre section summary table tbody tfoot thead tr ul caption legend".split()
)
_ARTICLE = frozenset(["article", "main"])
#: Names in a class, an id or a role that say that an element is furniture, if the whole name is made of them and of
#: words that only say which one: "ad", "site-nav", "cookie-banner", but neither "share-price" nor "form-factor".
_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs masthead topbar footer contentinfo sidebar complementary aside ad ads advert"
    " adverts advertisement advertisements adsense sponsored cookie cookies consent gdpr newsletter comment comments disqus"
    " pagination pager copyright".split()
)
_WHICH = frozenset(
    "site main page top bottom global primary secondary left right header bar box list links area section block wrapper container"
    " inner outer banner notice popup modal reader user post article slot unit form signup mobile desktop fixed sticky".split()
)
#: Names that say so only if they stand alone.
_ALONE = frozenset(
    "notice notices notification alert banner popup modal overlay promo promotion sponsor subscribe subscription login signup register"
    " respond reply replies share sharing social related recommended recommendations toolbar search form skip header".split()
)
_PHRASES = frozenset("related-posts related-articles social-share share-buttons search-form search-box skip-link site-header page-header".split())
#: Share of a page's characters over which a neighbour's word needs that of the host's other pages.
_COPY = 0.6
_LINKED = 0.6


def _furniture(name: str, attributes: str, in_article: bool) -> bool:
    if name in _FURNITURE and not (name == "header" and in_article):
        return True
    if not attributes or name in ("html", "body", "main", "article") and "comment" not in attributes.lower():
        return False
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values)
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
        if key in ("class", "id", "role"):
            for one in value.split():
                parts = [p.lower() for p in _PART.findall(one)]
                known = bool(parts) and all(p in _NAMES or p in _WHICH for p in parts) and not _NAMES.isdisjoint(parts)
                alone = len(parts) == 1 and parts[0] in _ALONE or "-".join(parts) in _PHRASES
                if known or alone and not (in_article and parts[-1] == "header"):
                    return True
    return False


def _says_article(name: str, attributes: str) -> bool:
    return name == "article" or "articleBody" in attributes


def _says_main(name: str, attributes: str) -> bool:
    return name == "main" or bool(attributes) and re.search(r"""role\s*=\s*["']?main\b""", attributes) is not None


def blocks(page: str | None) -> list[tuple[str, bool, float]]:
    """The blocks of text of a page in order: (text, whether in a declared article, share of its characters in links)."""
    page = page or ""
    out: list[tuple[str, bool, float]] = []
    parts: list[str] = []
    linked = 0
    article, around = ["", 0], ["", 0]  # tag and depth of the declared article, and of what is declared to hold it
    skip, skip_depth, skip_in_article = "", 0, False
    in_link = False

    def close() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append((text, article[1] > 0, min(1.0, linked / len(text))))
        parts.clear()
        linked = 0

    at, end = 0, len(page)
    while at < end:
        tag = _TAG.search(page, at)
        text = page[at : tag.start() if tag else end]
        if text and not skip:
            parts.append(text)
            linked += len(text) if in_link else 0
        if not tag:
            break
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        closing, attributes = bool(tag[1]), tag[3]
        if skip:
            if name in _ARTICLE and not closing and not skip_in_article and not _furniture(name, attributes, False):
                skip = ""  # an element that was never closed
            elif closing and name in ("body", "html") or skip == "p" and not closing and name in _BLOCKS:
                skip = ""
            else:
                if name == skip and not attributes.endswith("/"):
                    skip_depth += -1 if closing else 1
                    if skip_depth == 0:
                        skip = ""
                        continue
                if name in _RAW and not closing:
                    at = _after(page, name, at)
                if skip:
                    continue
        if name in _RAW:
            if not closing and not attributes.endswith("/"):
                at = _after(page, name, at)
            continue
        if name in _BLOCKS:
            close()
        elif name in ("br", "td", "th"):
            parts.append(" ")
        elif name == "a":
            in_link = not closing
        if closing:
            for held in (article, around):
                held[1] -= held[1] > 0 and name == held[0]
            continue
        if name in _VOID or attributes.endswith("/"):
            continue
        inside = article[1] > 0 or around[1] > 0
        if _furniture(name, attributes, inside):
            if name not in _BLOCKS:
                parts.append(" ")
            skip, skip_depth, skip_in_article = name, 1, inside
            continue
        for held, says in ((article, _says_article), (around, _says_main)):
            if held[1]:
                held[1] += name == held[0]
            elif says(name, attributes):
                held[:] = [name, 1]
    close()
    return out


def _after(page: str, name: str, at: int) -> int:
    """Where the element of raw text that began before `at` has ended."""
    found = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
    return found.end() if found else len(page)


def lines_of(page: str | None) -> list[tuple[str, bool]]:
    """Candidate lines of a page, (text, whether it stays if shared: in a declared article, and not made of links)."""
    return [(t, inside and links < _LINKED) for t, inside, links in blocks(page)]


def common(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Positions of a longest common subsequence, by bits: row i has a zero where the length grows at that column."""
    both = set(a) & set(b)
    at, bt = [i for i, x in enumerate(a) if x in both], [j for j, y in enumerate(b) if y in both]
    if not at:
        return []
    where: dict[int, int] = {}
    for k, j in enumerate(bt):
        where[b[j]] = where.get(b[j], 0) | 1 << k
    full = (1 << len(bt)) - 1
    row, rows = full, []
    for i in at:
        hit = row & where[a[i]]
        row = (row + hit | row - hit) & full
        rows.append(row)
    out, i, j = [], len(at) - 1, len(bt) - 1
    while i >= 0 and j >= 0:
        if rows[i] >> j & 1:
            j -= 1
        elif i and not rows[i - 1] >> j & 1:
            i -= 1
        else:
            out.append((at[i], bt[j]))
            i, j = i - 1, j - 1
    return out[::-1]


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [lines_of(p) for p in batch["html"]]
        yield batch.drop(columns="html").assign(
            lines=[[xxhash.xxh64_intdigest(t.encode("utf-8", "replace")) - (1 << 63) for t, _ in x] for x in found],
            sizes=[[len(t) for t, _ in x] for x in found],
            kept=[[p for _, p in x] for x in found],
        )


def _shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines of each page to take out, by the nearer neighbour that does not share most of it, else by the nearer one that
    leaves it a line; then `doubt` has their hashes."""
    for batch in batches:
        out = []
        for r in batch.itertuples(index=False):
            lines, sizes = list(r.lines), list(r.sizes)
            near = [(n["path"], list(n["lines"])) for n in (r.before, r.after) if n is not None and n["host"] == r.host]
            near.sort(key=lambda n: -_prefix(n[0], r.path))
            found = [m for m in ([i for i, _ in common(lines, other)] for _, other in near) if len(m) < len(lines)]
            sure = [m for m in found if sum(sizes[i] for i in m) <= _COPY * sum(sizes)]
            gone = [i for i in (sure or found or [[]])[0] if not r.kept[i]]
            if gone:
                out.append((r.host, r.same, gone, [] if sure else [lines[i] for i in gone]))
        yield pd.DataFrame(out, columns=["host", "same", "gone", "doubt"])


def _prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def shared_lines(pages: DataFrame) -> DataFrame:
    """(page_id, told, gone): positions, among a page's candidate lines, of lines to take out; only pages that have some.

    `told` is the hash of url and html.
    """
    url = F.coalesce("url", F.lit(""))
    pages = pages.where("page_id is not null and html is not null").select(
        "page_id", F.xxhash64("url", "html").alias("told"), F.lower(F.regexp_extract(url, r"^[A-Za-z][\w+.-]*://([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(url, r"^[A-Za-z][\w+.-]*://[^/?#]*([^?#]*)", 1).alias("path"), "html",
    ).where("host <> ''")
    shape = "page_id long, told long, host string, path string, lines array<long>, sizes array<int>, kept array<boolean>"
    narrow = pages.mapInPandas(_hashed, shape).withColumn("same", F.sha2(F.concat_ws(",", F.col("lines").cast("array<string>"), F.col("kept").cast("array<string>")), 256))
    narrow = pin(narrow, "lines")
    one = F.min_by(F.struct("path", "lines", "sizes", "kept"), F.struct("path", "page_id"))
    different = pin(narrow.groupBy("host", "same").agg(one.alias("one")).select("host", "same", "one.*"), "different")
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["host", "path", "same"]
    dealt = pin(different.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "ordered")
    one = F.struct("host", "path", "lines")
    ends = dealt.groupBy("part").agg(F.min_by(one, F.struct(*order)).alias("first"), F.max_by(one, F.struct(*order)).alias("last"))
    across = Window.orderBy("part")  # one row a part
    ends = ends.select("part", F.lag("last").over(across).alias("above"), F.lead("first").over(across).alias("below"))
    within = Window.partitionBy("part").orderBy(*order)
    paired = dealt.select("*", F.lag(one).over(within).alias("b"), F.lead(one).over(within).alias("a")).join(F.broadcast(ends), "part")
    paired = paired.select("host", "same", "path", "lines", "sizes", "kept", F.coalesce("b", "above").alias("before"), F.coalesce("a", "below").alias("after"))
    found = pin(paired.mapInPandas(_shared, "host string, same string, gone array<int>, doubt array<long>"), "shared")
    gone = _undoubted(found, different)
    return narrow.select("page_id", "told", "host", "same").join(gone, ["host", "same"]).select("page_id", "told", "gone")


def _undoubted(found: DataFrame, different: DataFrame) -> DataFrame:
    """(host, same, gone) of `found`, less lines in doubt that no more than half of the different pages of the host have."""
    sure, doubtful = found.where("size(doubt) = 0").select("host", "same", "gone"), found.where("size(doubt) > 0")
    if doubtful.isEmpty():
        return sure
    here = different.join(doubtful.select("host").distinct(), "host", "left_semi")
    held = here.select("host", F.explode(F.array_distinct("lines")).alias("line")).groupBy("host", "line").agg(F.count("*").alias("n"))
    most = held.join(here.groupBy("host").agg(F.count("*").alias("pages")), "host").where("2 * n > pages")
    most = most.groupBy("host").agg(F.collect_list("line").alias("most"))  # no more than two average pages have
    agreed = F.expr("transform(filter(arrays_zip(gone, doubt), x -> array_contains(most, x.doubt)), x -> x.gone)")
    return sure.unionByName(doubtful.join(most, "host").select("host", "same", agreed.alias("gone")).where("size(gone) > 0"))


def _texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for page, gone in zip(batch["html"], batch["gone"]):
            lines = [t for t, _ in lines_of(page)]
            if gone is not None:
                left_out = set(np.asarray(gone).tolist())
                lines = [t for i, t in enumerate(lines) if i not in left_out]
            out.append("\n".join(lines))
        yield batch.drop(columns=["html", "gone"]).assign(text=out, n_chars=[len(t) for t in out])


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars for every row of `pages`.

    A null html is empty, and so is its text. Pages without a page_id or without a host in their url are not compared with
    others. Rows with one page_id and different pages are compared like any others. Repeated rows come back as often as
    they came; other columns are ignored.
    """
    given = pages.select("page_id", "url", "html")
    gone = pin(shared_lines(given).dropDuplicates(["page_id", "told"]), "gone")
    given = given.withColumn("told", F.xxhash64("url", "html"))
    return given.join(gone, ["page_id", "told"], "left").select("page_id", "url", "html", "gone").mapInPandas(_texts, "page_id long, url string, text string, n_chars long")


def op6_page_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))


ship(__name__)

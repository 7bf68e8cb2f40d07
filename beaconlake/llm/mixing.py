"""Mixing sources to target weights, in DataFrame functions only.

Domains are the sources. What a document belongs to is soft: a naive Bayes table, counted over all rows whose source is
known, gives every document a posterior over domains from its declared source, which may be wrong or missing, and from
its language, length, line and word sizes. A rate of 0 or more per document, how often to take it, is then fitted so that
the expected tokens of every domain meet their target: least squares over domains, each error relative to the
domain's own tokens, with a small pull of each rate towards 1, over rates of 0 or more.

At the best rates, a document's is 1 less its posterior's product with the domains' errors over the pull, and 0 where that
is negative: one number per domain tells all rates. Documents with equal features thus have equal rates, and the fit
runs over feature cells with summed tokens, grouped before the shuffle. The numbers are found by Newton's method, each of
its linear systems by conjugate gradients. A pass is one job over the cells that brings a few numbers per domain to the
driver, and no pass hangs on the files of the one before. It is projected gradient descent run to its end, in fewer passes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.llm.common import WORD, packed, table
from beaconlake.storage import pin

#: Targets, where none are given: each domain's tokens to this power.
TEMPER = 0.5
#: Share of declared sources taken to be wrong, weight of a never seen feature value, and of the pull towards rate 1.
NOISE, SMOOTH, PULL = 0.02, 0.5, 1e-3
#: Passes over the cells after which a fit has failed, and the error, as share of a domain's tokens, at which it has ended.
STEPS, CLOSE = 20_000, 1e-9
#: Domains come to the driver, one row each.
MOST_DOMAINS = 10_000
_NONE = "\x00"
_FEATURES = ["lang", "size", "lines", "letters"]
_CELL = ["source", *_FEATURES]


def featured(docs: DataFrame) -> DataFrame:
    """`docs` with `_tokens` and the struct `_cell` of its features."""
    text = F.coalesce("text", F.lit(""))
    tokens = F.regexp_count(text, F.lit(WORD)).cast("long")
    more = docs.withColumn("_tokens", tokens)
    breaks = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    step = lambda x: F.floor(F.log2(1.0 + x)).cast("int")
    return more.withColumn("_cell", F.struct(
        F.coalesce("source", F.lit(_NONE)).alias("source"), F.coalesce("lang", F.lit(_NONE)).alias("lang"),
        step(F.col("_tokens")).alias("size"), step(F.col("_tokens") / (breaks + 1)).alias("lines"),
        F.least(F.lit(20), (F.length(text) / F.greatest(F.col("_tokens"), F.lit(1))).cast("int")).alias("letters"),
    ))


def grouped(rows: DataFrame) -> DataFrame:
    """The cells of `featured` rows: their features, `docs` and `tokens`."""
    return rows.groupBy("_cell").agg(F.count("*").alias("docs"), F.sum("_tokens").alias("tokens")).select("_cell.*", "docs", "tokens")


def domain_tokens(cells: DataFrame) -> dict[str, int]:
    """Tokens by declared source."""
    rows = cells.where(F.col("source") != _NONE).groupBy("source").agg(F.sum("tokens").alias("n")).limit(MOST_DOMAINS + 1).collect()
    if len(rows) > MOST_DOMAINS:
        raise ValueError(f"more than {MOST_DOMAINS} domains")
    return {r.source: r.n for r in rows}


def _doubles(xs: list[float]) -> Column:
    return F.array(*(F.lit(float(x)) for x in xs)) if xs else F.array().cast("array<double>")


def with_posterior(cells: DataFrame, domains: list[str]) -> DataFrame:
    """`cells` with `p`, the posterior over `domains` in their order, from counts over all cells of a known domain.

    Of the declared sources of a domain, NOISE are wrong, dealt evenly over the others, but no more than so many that all
    wrong ones together are half as many as the documents of the source they name.
    """
    known = cells.where(F.col("source").isin(domains))
    sizes = {r.source: r.n for r in known.groupBy("source").agg(F.sum("docs").alias("n")).collect()}
    total = sum(sizes.values())
    count = len(domains)
    out = cells.withColumn("l", _doubles([math.log((sizes.get(d, 0) + SMOOTH) / (total + SMOOTH * count)) for d in domains]))
    names, held = F.array(*map(F.lit, domains)), _doubles([sizes.get(d, 0) for d in domains])
    for f in _FEATURES:
        per = known.groupBy(f, "source").agg(F.sum("docs").alias("n"))
        values = F.lit(float(known.select(f).distinct().count() + 1))
        seen = per.groupBy(f).agg(F.map_from_entries(F.collect_list(F.struct("source", "n"))).alias("m"))  # one entry a domain
        counts = F.transform(names, lambda d: F.coalesce(F.try_element_at("m", d).cast("double"), F.lit(0.0)))
        seen = seen.select(f, counts.alias("c"))
        out = out.join(seen, f, "left")
        c = F.coalesce("c", _doubles([0.0] * count))
        log = F.zip_with(c, held, lambda n, h: F.ln((n + SMOOTH) / (h + F.lit(SMOOTH) * values)))
        out = out.withColumn("l", F.zip_with("l", log, lambda a, b: a + b)).drop("c")
    others, own = max(1, count - 1), F.element_at(held, F.array_position(names, F.col("source")).cast("int")) + SMOOTH
    wrong = lambda n: F.ln(F.least(F.lit(NOISE / others), own / (2.0 * others * (n + SMOOTH))))
    said = F.zip_with(names, held, lambda d, n: F.when(F.col("source") == d, math.log(1 - NOISE)).otherwise(wrong(n)))
    out = out.withColumn("l", F.when(F.col("source").isin(domains), F.zip_with("l", said, lambda a, b: a + b)).otherwise(F.col("l")))
    out = out.withColumn("e", F.transform("l", lambda x: F.exp(x - F.array_max("l"))))
    total_e = F.aggregate("e", F.lit(0.0), lambda s, x: s + x)
    return out.withColumn("t", total_e).withColumn("p", F.transform("e", lambda x: x / F.col("t"))).drop("l", "e", "t")


def _dot(a: list[float], b: list[float]) -> float:
    return math.fsum(x * y for x, y in zip(a, b))


def fit_rates(cells: DataFrame, targets: list[float]) -> tuple[DataFrame, list[float]]:
    """`cells` (with `p` and `tokens`) with `rate`, and the expected tokens per domain. `targets` are tokens, over 0.

    With x = max(0, 1 - p.y / PULL), the rates are best if held * y = expected(x) - targets. That is where the convex
    function sum(held * y * y) / 2 + targets.y + PULL / 2 * sum(tokens * x * x) is least. Raises if that is not reached.
    """
    count, passes = len(targets), 0
    tokens = F.col("tokens").cast("double")
    along = lambda y: F.aggregate(F.zip_with("p", _doubles(y), lambda a, b: a * b), F.lit(0.0), lambda t, z: t + z)
    rate = lambda y: F.greatest(F.lit(0.0), 1.0 - along(y) / PULL)

    def sums(of: DataFrame, values: Column, n: int) -> list[float]:
        nonlocal passes
        passes += 1
        rows = of.select(F.posexplode(values).alias("i", "v")).groupBy("i").agg(F.sum("v").alias("s")).collect()
        found = {r.i: r.s or 0.0 for r in rows}
        return [found.get(i, 0.0) for i in range(n)]

    def state(y: list[float]) -> tuple[list[float], list[float], float]:
        """Expected tokens, the diagonal of the tokens' part of the second derivative, and sum(tokens * x * x)."""
        of = cells.select("p", tokens.alias("n"), rate(y).alias("x"))
        values = F.concat(
            F.transform("p", lambda q: F.col("n") * F.col("x") * q),
            F.transform("p", lambda q: F.when(F.col("x") > 0, F.col("n") * q * q / PULL).otherwise(0.0)),
            F.array(F.col("n") * F.col("x") * F.col("x")),
        )
        found = sums(of, values, 2 * count + 1)
        return found[:count], found[count : 2 * count], found[-1]

    y = [0.0] * count
    now, diagonal, square = state(y)
    held = [max(n, 1e-9) for n in now]
    allowed = [CLOSE * max(t, h) for t, h in zip(targets, held)]

    def slope(y: list[float], now: list[float]) -> list[float]:
        return [h * v + t - n for h, v, t, n in zip(held, y, targets, now)]

    def value(y: list[float], square: float) -> float:
        return math.fsum(h * v * v for h, v in zip(held, y)) / 2 + _dot(targets, y) + PULL / 2 * square

    def residual(g: list[float]) -> float:
        return max((abs(x) / a for x, a in zip(g, allowed)), default=0.0)

    g = slope(y, now)
    while residual(g) > 1.0:
        # conjugate gradients for the Newton step, each number scaled by the diagonal
        scale = [h + d for h, d in zip(held, diagonal)]
        step, left = [0.0] * count, [-x for x in g]
        z = [x / s for x, s in zip(left, scale)]
        way, size = z, _dot(left, z)
        enough = size * min(0.1, math.sqrt(residual(g) * CLOSE)) ** 2
        active = cells.select("p", F.when(rate(y) > 0, tokens / PULL).otherwise(0.0).alias("n"))
        for _ in range(2 * count + 10):
            bent = sums(active.select("p", (F.col("n") * along(way)).alias("n")), F.transform("p", lambda q: q * F.col("n")), count)
            bent = [b + h * w for b, h, w in zip(bent, held, way)]
            by = size / _dot(way, bent)
            step = [a + by * w for a, w in zip(step, way)]
            left = [a - by * b for a, b in zip(left, bent)]
            z = [x / s for x, s in zip(left, scale)]
            was, size = size, _dot(left, z)
            if size <= enough or passes > STEPS:
                break
            way = [a + size / was * w for a, w in zip(z, way)]
        was, fall, part = value(y, square), _dot(g, step), 1.0
        while True:
            then = [a + part * b for a, b in zip(y, step)]
            now, diagonal, square = state(then)
            after = slope(then, now)
            if value(then, square) <= was + 1e-4 * part * fall or residual(after) < residual(g) / 2:
                break
            part /= 2
            if passes > STEPS or part < 1e-9:
                raise RuntimeError(f"the rates miss their best by {residual(g) * CLOSE:.2g} of a domain's tokens after {passes} passes")
        y, g = then, after
        if passes > STEPS and residual(g) > 1.0:
            raise RuntimeError(f"the rates miss their best by {residual(g) * CLOSE:.2g} of a domain's tokens after {passes} passes")
    return cells.withColumn("rate", rate(y)), now


def rates(rows: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(cell, domain, domain_share, rate) per feature cell of `featured` rows.

    `weights` are the domains' shares of all tokens, by default tokens ** TEMPER; domains of weight 0 or less, and sources
    that it does not name, are no domains: their documents are shared out by their other features.
    """
    cells = pin(grouped(rows), "cells")
    held = domain_tokens(cells)
    weights = {d: w for d, w in (weights or {d: n**TEMPER for d, n in held.items()}).items() if w > 0}
    domains = sorted(weights)
    if not domains:
        told = cells.withColumns({"domain": F.lit(None).cast("string"), "domain_share": F.lit(0.0), "rate": F.lit(1.0)})
    else:
        total = cells.agg(F.sum("tokens")).first()[0] or 0
        targets = [max(total, 1) * weights[d] / sum(weights.values()) for d in domains]
        known = pin(with_posterior(cells, domains), "posteriors")
        fitted, _ = fit_rates(known, targets)
        best = F.array_max("p")
        at = F.array_position("p", best).cast("int")
        told = fitted.withColumns({"domain": F.element_at(F.array(*map(F.lit, domains)), at), "domain_share": best})
    return told.select(F.struct(*_CELL).alias("_cell"), "domain", "domain_share", "rate")


def mixed(docs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """doc_id, tokens, domain, domain_share and rate for every row of `docs`.

    `domain` is the likeliest and `domain_share` its posterior; `rate` says how often to take the document. Rows with a
    null source, language or text are shared out by what is left. If no row has a source, every rate is 1. Repeated
    rows get equal rates; other columns are ignored.
    """
    rows = pin(featured(docs.select("doc_id", "text", "lang", "source")).select("doc_id", "_tokens", "_cell"), "features")
    told = pin(rates(rows, weights), "rates")
    return rows.join(told, "_cell", "left").select("doc_id", F.col("_tokens").alias("tokens"), "domain", "domain_share", "rate")


def with_rate(docs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """`docs` with the column `rate` after its own; a column of that name gives way."""
    kept = docs.drop("rate")
    rows = featured(packed(kept, "text", "lang", "source"))
    told = pin(rates(rows.select("_tokens", "_cell"), weights), "rates").select(F.col("_cell"), F.col("rate"))
    return rows.join(told, "_cell", "left").select("row.*", "rate")


def op4_soft_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"))

"""Which landed response pages a correct pagination would have consumed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconlake.operators.quantiles import join_groups
from beaconlake.storage import pin


def with_next_token(pages: DataFrame, member: str = "nextToken") -> DataFrame:
    """Adds the token by which each landed JSON page (`body`) names the next one; '' if it names none."""
    found = F.from_json("body", f"`{member}` string")[member]
    return pages.withColumn("next_token", F.coalesce(found, F.lit("")))


def accept_pages(pages: DataFrame, mode: str = "previous", request: str = "request_id") -> DataFrame:
    """Keeps each request's pages up to the one that ends its chain.

    `pages` has `request`, `page_no`, `next_token` and, for `previous`, `token_in`. A chain ends after a page without a next
    token, and after one whose next token is the token it was requested with (`previous`) or was returned by an
    earlier page of the request (`seen`). Only minima per request meet in one place, so a request may hold any
    number of pages.
    """
    token = F.coalesce("next_token", F.lit(""))
    used = F.coalesce("token_in", F.lit("")) if mode == "previous" else F.lit(None).cast("string")
    slim = pages.select(F.col(request).alias("request_id"), "page_no", token.alias("token"), used.alias("used"))
    last = F.col("token") == ""
    if mode == "previous":
        ends = slim.filter(last | (F.col("token") == F.col("used")))
    elif mode == "seen":
        first = slim.groupBy("request_id", "token").agg(F.min("page_no").alias("first_page"))
        again = join_groups(slim, first, ["request_id", "token"])
        ends = again.filter(last | (F.col("page_no") > F.col("first_page")))
    else:
        raise ValueError("mode must be 'previous' or 'seen'")
    end = ends.groupBy("request_id").agg(F.min("page_no").alias("_end"))
    joined = pages.alias("p").join(end.alias("e"), F.col(f"p.{request}").eqNullSafe(F.col("e.request_id")), "left")
    return joined.filter(F.col("_end").isNull() | (F.col("p.page_no") <= F.col("_end"))).select("p.*")


def order_pages(pages: DataFrame, request: str = "request_id", start: str = "") -> DataFrame:
    """Adds `page_no`, from 0, to the pages that are reached by following tokens, and leaves out the others.

    `pages` has `request`, `token_in` and `next_token`; NULL tokens count as empty ones. A request begins with the page
    that was asked for with the token `start`, and each page is followed by the one asked for with its next token. A
    chain ends at a page that names no next token, its own, one whose page was not landed, or one that came before.
    Of several pages of a request and token the least by next token and content counts, and of equal rows one.

    The place in the chain is found by pointer doubling over all requests at once: after k rounds the pages of the first
    2 ** k places are known, and each page knows the one 2 ** k places on. A chain of n pages takes log2(n) rounds of
    joins on page numbers, each written to the shared folder, and no request's pages ever meet in one task. A page
    from which nothing is 2 ** k places on takes part in no later round. Contents are moved twice, to choose among pages
    of a token and to add the place.
    """
    token, after = F.coalesce("token_in", F.lit("")), F.coalesce("next_token", F.lit(""))
    content = F.xxhash64(F.to_json(F.struct(*[F.col(c) for c in pages.columns])))
    row = F.struct(*[F.col(c) for c in pages.columns if c != "page_no"])
    chosen = pages.groupBy(F.col(request).alias("request"), token.alias("token")).agg(F.min_by(row, F.struct(after, content)).alias("row"))
    nodes = pin(chosen.select(F.monotonically_increasing_id().alias("id"), "row"), "page-nodes")
    token, after = F.coalesce("row.token_in", F.lit("")), F.coalesce("row.next_token", F.lit(""))
    named = nodes.select("id", F.col("row").getField(request).alias("request"), token.alias("token"), after.alias("after"))
    here = named.filter((F.col("after") != "") & (F.col("after") != F.col("token"))).select("request", F.col("after").alias("token"), "id")
    there = named.select(F.col("request").alias("_request"), F.col("token").alias("_token"), F.col("id").alias("to"))
    same = F.col("request").eqNullSafe(F.col("_request")) & (F.col("token") == F.col("_token"))
    jump, far = pin(here.join(there, same).select("id", "to"), "page-jumps"), 1
    live = named.filter(F.col("token") == start).select("id", F.lit(0).cast("long").alias("page_no"))
    places, before = [], None
    while True:
        met = pin(live.join(jump, "id", "left").select("id", "page_no", "to"), "page-places")
        size = met.agg(F.count("*").alias("all"), F.count("to").alias("going")).first()
        if size["going"] == 0 or size["all"] == before:  # every chain has ended, or what goes on goes round
            places.append(met.select("id", "page_no"))
            break
        before = size["going"]
        places.append(met.filter(F.col("to").isNull()).select("id", "page_no"))
        going = met.filter(F.col("to").isNotNull())
        onward = going.select(F.col("to").alias("id"), (F.col("page_no") + far).alias("page_no"))
        live = going.select("id", "page_no").unionByName(onward).groupBy("id").agg(F.min("page_no").alias("page_no"))
        further = jump.select(F.col("id").alias("to"), F.col("to").alias("further"))
        jump, far = pin(jump.join(further, "to").select("id", F.col("further").alias("to")), "page-jumps"), 2 * far
    placed = reduce(DataFrame.unionByName, places)
    return nodes.join(placed, "id").select("row.*", "page_no")

"""Chains of pages that link to their next page: the listing of every page and its place there."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweave.session import materialized


def _walked_back(pages: DataFrame) -> DataFrame:
    """``(url, listing, position)`` from ``(url, before)``, where no two pages have the same page before them.

    Pointer doubling: after round k a page knows the page 2^k places before it, or the first page if that comes sooner, and the
    smallest url passed on the way. Each round joins the pages that have not met their first page with all pages, one row to one row,
    and stores those pages alone; a chain of n pages takes log2(n) rounds.
    """
    here = F.struct(F.col("url").alias("low"), F.lit(0).cast("long").alias("at")).alias("low")
    known = pages.select("url", F.col("before").alias("prev"), F.col("before").isNotNull().cast("long").alias("steps"), F.when(F.col("before").isNull(), F.col("url")).alias("first"), here)
    known = materialized(known)
    done, open_ = [known.where("prev IS NULL")], known.where("prev IS NOT NULL")
    left, reach = open_.count(), 1
    while left:
        every = reduce(DataFrame.unionByName, [*done, open_]).withColumnsRenamed({c: f"b_{c}" for c in known.columns})
        low = F.least("low", F.struct(F.col("b_low.low").alias("low"), (F.col("b_low.at") + F.col("steps")).alias("at")))
        joined = open_.join(every, open_["prev"] == F.col("b_url"))
        moved = materialized(joined.select("url", F.col("b_prev").alias("prev"), (F.col("steps") + F.col("b_steps")).alias("steps"), F.col("b_first").alias("first"), low.alias("low")))
        done.append(moved.where("prev IS NULL"))
        open_ = moved.where("prev IS NOT NULL")
        before, left, reach = left, open_.count(), 2 * reach
        # Where no page has met its first page, only rings are left; they are known once the walk is as long as they can be.
        if left == before and reach >= left:
            break
    met = reduce(DataFrame.unionByName, done).select("url", F.col("first").alias("listing"), (F.col("steps") + 1).alias("position"))
    return met.unionByName(open_.select("url", F.col("low.low").alias("listing"), (F.col("low.at") + 1).alias("position")))


def page_chains(links: DataFrame) -> DataFrame:
    """One row ``(url, next_url, listing, position, link)`` per url of ``(url, next_url)``.

    ``listing`` is the first page of the chain and ``position`` the place in it, from 1. ``link`` says where the next link leads:

    * ``next``: to the following page of the chain;
    * ``merge``: into another chain. Of several pages that link to one, the page with the smallest url has it in its chain;
    * ``loop``: back into the own chain (also a page that links to itself). A ring starts at its smallest url;
    * ``outside``: to a page that is not among the rows; NULL without a link.

    Rows without a url are left out; of several rows of a url the smallest link counts. An empty table gives no rows.
    """
    pages = materialized(links.where("url IS NOT NULL").groupBy("url").agg(F.min("next_url").alias("next_url")))
    before = pages.where("next_url <> url").groupBy("next_url").agg(F.min("url").alias("before")).withColumnRenamed("next_url", "u")
    placed = materialized(_walked_back(pages.join(before, F.col("url") == F.col("u"), "left").select("url", "before")))
    target = placed.select(F.col("url").alias("t_url"), F.col("listing").alias("t_listing"), F.col("position").alias("t_position"))
    link = (
        F.when(F.col("next_url").isNull(), None)
        .when(F.col("t_url").isNull(), "outside")
        .when(F.col("t_listing") != F.col("listing"), "merge")
        .when(F.col("t_position") == F.col("position") + 1, "next")
        .otherwise("loop")
    )
    return pages.join(placed, "url").join(target, F.col("next_url") == F.col("t_url"), "left").select("url", "next_url", "listing", "position", link.alias("link"))

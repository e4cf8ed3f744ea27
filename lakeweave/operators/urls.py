"""Url planning: pages to fetch, cursors, request bodies, and the robots filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweave.operators.extract import page_cursor


def _form_encode(c: Column) -> Column:
    """Form encoding that keeps ``~`` and escapes ``*``."""
    encoded = F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A"))
    return F.replace(encoded, F.lit("%7E"), F.lit("~"))


def _form_decode(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), c)


def set_query_param(url: Column, name: str, value: Column) -> Column:
    """Url with one query parameter set; the others keep their first value and their order."""
    fragment = F.when(F.contains(url, F.lit("#")), F.concat(F.lit("#"), F.regexp_extract(url, "#(.*)$", 1))).otherwise("")
    no_fragment = F.substring_index(url, "#", 1)
    base = F.substring_index(no_fragment, "?", 1)
    query = F.regexp_extract(no_fragment, r"\?(.*)$", 1)
    pairs = F.transform(
        F.filter(F.split(query, "&"), lambda p: p != ""),
        lambda p: F.struct(
            _form_decode(F.substring_index(p, "=", 1)).alias("k"),
            _form_decode(F.regexp_extract(p, "=(.*)$", 1)).alias("v"),
        ),
    )
    keys = F.array_distinct(F.array_append(F.transform(pairs, lambda p: p["k"]), F.lit(name)))

    def render(key: Column) -> Column:
        kept = F.element_at(F.filter(pairs, lambda p: p["k"] == key), 1)["v"]
        chosen = F.when(key == name, value.cast("string")).otherwise(kept)
        return F.concat(_form_encode(key), F.lit("="), _form_encode(chosen))

    return F.concat(base, F.lit("?"), F.array_join(F.transform(keys, render), "&"), fragment)


def next_page_url(url: Column, current_page: Column, max_pages: int, param: str = "page") -> Column:
    """Url of the page after ``current_page``; NULL once ``max_pages`` is reached."""
    following = current_page + 1
    return F.when(following <= max_pages, set_query_param(url, param, following))


def page_urls(seeds: DataFrame, max_pages: int, param: str = "page", url: str = "url") -> DataFrame:
    """One row per url to fetch: the seed itself is page 1, later pages set the parameter."""
    planned = seeds.withColumn("page_no", F.explode(F.sequence(F.lit(1), F.lit(max_pages))))
    target = F.when(F.col("page_no") == 1, F.col(url)).otherwise(set_query_param(F.col(url), param, F.col("page_no")))
    return planned.withColumn("page_url", target)


def cursor_urls(
    pages: DataFrame, selector: str, param: str = "cursor", attribute: str = "data-cursor", html: str = "html"
) -> DataFrame:
    """Next url of each page from the cursor it shows; NULL when it shows none."""
    found = page_cursor(pages, selector, attribute, html)
    target = F.when(F.col("cursor").isNotNull(), set_query_param(F.col("url"), param, F.col("cursor")))
    return found.withColumn("next_url", target)


DEFAULT_LIMIT = 20


def request_bodies(plan: DataFrame, template: dict, mode: str) -> DataFrame:
    """JSON request body per planned request (``page_no`` and, in cursor mode, ``cursor``)."""
    fixed = {k: F.lit(v) for k, v in template.items()}

    def body(**extra: Column) -> Column:
        return F.to_json(F.struct(*[v.alias(k) for k, v in {**fixed, **extra}.items()]))

    if mode == "page":
        rendered = body(page=F.col("page_no"))
    elif mode == "cursor":
        offset = (F.col("page_no") - 1) * F.lit(template.get("limit", DEFAULT_LIMIT))
        has_cursor = F.col("cursor").isNotNull() & (F.col("cursor") != "")
        rendered = F.when(has_cursor, body(after=F.col("cursor"))).otherwise(body(offset=offset))
    else:
        rendered = body()
    return plan.withColumn("body", rendered)


def host_rules(rules: DataFrame, agent: str = "*") -> DataFrame:
    """The rules that hold for ``agent``, one row per host and prefix: ``(host, path_prefix, rule_no, allow)``.

    ``rules`` has (host, agent, rule_no, path_prefix, allow). The rules of a host that name the agent win over those for
    ``*``. Of equal prefixes the first rule counts. The prefix ``*`` fits every path, like the empty one.
    """
    token = agent.split("/")[0].lower()
    named = (F.col("agent") != "*") & F.contains(F.lit(token), F.lower("agent"))
    relevant = rules.where(((F.col("agent") == "*") | named) & F.col("host").isNotNull() & F.col("path_prefix").isNotNull())
    relevant = relevant.select("host", "rule_no", "allow", F.when(F.col("path_prefix") == "*", "").otherwise(F.col("path_prefix")).alias("path_prefix"), named.alias("named"))
    own = relevant.groupBy("host").agg(F.max("named").alias("own"))
    held = relevant.join(own, "host").where("named = own")
    return held.groupBy("host", "path_prefix").agg(F.min("rule_no").alias("rule_no"), F.min_by("allow", "rule_no").alias("allow"))


def _key(*parts: Column) -> list[Column]:
    """128 bits for a join: two hashes of the same texts that have nothing to do with each other."""
    return [F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts)]


def robots_filter(urls: DataFrame, rules: DataFrame, agent: str = "*", enabled: bool = True, url: str = "url") -> DataFrame:
    """Add ``allowed``: the first rule whose prefix fits decides; no rule, or no file, allows.

    Prefixes are join keys: a path is cut to the lengths that rules of its host have, and every cut meets the rules by hash. So a host with very many
    rules costs a url no more than its distinct lengths, no row holds a list of rules, and paths do not travel: urls are hashes in
    the joins, which the adaptive skew join splits where one host has most of them. Nothing is broadcast by hint.
    """
    if not enabled:
        return urls.withColumn("allowed", F.lit(True))
    parts = F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^#]*)", 1)
    path = F.when(parts.startswith("/"), parts).otherwise(F.concat(F.lit("/"), parts))
    host = F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)
    rules = host_rules(rules, agent)
    lengths = rules.groupBy("host").agg(F.collect_set(F.length("path_prefix")).alias("lengths"))
    u1, u2 = _key(host, path)
    # One row per different url; only hosts with rules are cut.
    wanted = urls.select(u1.alias("u1"), u2.alias("u2"), host.alias("host"), path.alias("path")).where(F.col("path").isNotNull()).dropDuplicates(["u1", "u2"])
    cuts = wanted.join(lengths, "host").select("u1", "u2", "host", "path", F.explode(F.filter("lengths", lambda n: n <= F.length("path"))).alias("n"))
    k1, k2 = _key(F.col("host"), F.left("path", F.col("n")))
    r1, r2 = _key(F.col("host"), F.col("path_prefix"))
    hits = cuts.select("u1", "u2", k1.alias("k1"), k2.alias("k2")).join(rules.select(r1.alias("k1"), r2.alias("k2"), "rule_no", "allow"), ["k1", "k2"])
    first = hits.groupBy("u1", "u2").agg(F.min_by("allow", "rule_no").alias("__allow")).withColumnsRenamed({"u1": "__u1", "u2": "__u2"})
    joined = urls.withColumns({"__u1": u1, "__u2": u2}).join(first, ["__u1", "__u2"], "left")
    return joined.withColumn("allowed", F.coalesce("__allow", F.lit(True))).drop("__u1", "__u2", "__allow")

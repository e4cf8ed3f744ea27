"""URL filter: host-suffix and path-prefix expressions, matched by short hash prefix, confirmed by digest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://`` or for null."""
    return _ascii_lower(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _ascii_lower(host: Column) -> Column:
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))


def _folder(path: Column) -> Column:
    """The path up to and with its last slash."""
    return F.regexp_extract(path, r"(?s)^(.*/)?", 1)


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def _short(expression: Column) -> Column:
    """A 32-bit prefix of a hash: the join key. Equal expressions share it; others may, so digests decide."""
    return F.shiftrightunsigned(F.xxhash64(expression), 32)


def expand_rules(rules: DataFrame) -> DataFrame:
    """Rules ``(host, path, verdict)`` with their folder expression's digest and short key, and its shape: labels of the host, folders of the path.
    Incomplete rules fit nothing."""
    host, path = _ascii_lower(F.col("host")), F.col("path")
    folder = _folder(path)
    expression = F.concat(host, F.lit("\n"), folder)
    return rules.where("host is not null and path is not null and verdict is not null").select(
        host.alias("rule_host"), path.alias("rule_path"), F.col("verdict").alias("rule_verdict"), _short(expression).alias("short"), _digest(expression).alias("digest"),
        F.struct(_marks(host, ".").alias("dots"), _marks(folder, "/").alias("slashes")).alias("shape"),
    )


def _marks(text: Column, mark: str) -> Column:
    """How often a character occurs."""
    return (F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))).cast("int")


def _expression(host: Column, path: Column, shape: Column) -> Column:
    """The host's last labels and the path's first folders, as many as a shape has. With fewer of them it is the whole host or path,
    which no rule of that shape equals or, as the path is compared in full at the end, fits."""
    suffix = F.expr("substring_index(host, '.', -(shape.dots + 1))")
    prefix = F.when(shape["slashes"] == 0, "").otherwise(F.concat(F.expr("substring_index(path, '/', shape.slashes)"), F.lit("/")))
    return F.concat(suffix, F.lit("\n"), prefix)


def matched_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Each distinct url that some rule fits, with the winning rule: ``(url_id, rule, rule_verdict)``; the id is the SHA-256 of the url.

    A url is expanded into pairs of a host suffix and a path prefix, but only of the shapes (numbers of labels and folders) that rules have, so a url costs
    no more than their number, however many dots and slashes it has. Rules enter with the folder of their path and meet expressions on
    32 bits of a hash, are confirmed by SHA-256 of the whole expression, and then have to be a prefix of the whole path. Only ids and
    hashes travel until a rule is confirmed. The longest rule
    text wins; equal lengths go to the longer host, then to block, then to the greater text.
    """
    rules = expand_rules(rules)
    shapes = rules.agg(F.collect_set("shape")).scalar()  # as many as rules differ in labels and folders
    urls = pages.select("url").where(F.instr("url", "://") > 0).select(_digest(F.col("url")).alias("url_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    expression = _expression(F.col("host"), F.col("path"), F.col("shape"))
    expressions = (
        urls.withColumn("shape", F.explode(shapes)).withColumn("expression", expression)
        .select("url_id", _short(F.col("expression")).alias("short"), _digest(F.col("expression")).alias("digest")).distinct()
    )
    hits = expressions.join(rules.drop("shape"), ["short", "digest"]).drop("short", "digest")
    paths = urls.select("url_id", "path").join(hits.select("url_id").distinct(), "url_id", "left_semi").dropDuplicates(["url_id"])
    hits = hits.join(paths, "url_id").where(F.startswith("path", "rule_path"))
    rule = F.concat("rule_host", "rule_path")
    best = F.max_by(
        F.struct(rule.alias("rule"), "rule_verdict"),
        F.struct(F.length(rule), F.length("rule_host"), F.col("rule_verdict") == BLOCK, rule),
    )
    return hits.groupBy("url_id").agg(best.alias("b")).select("url_id", "b.rule", "b.rule_verdict")


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = ALLOW) -> DataFrame:
    """Host, path, winning rule and verdict of every page row: ``(page_id, host, path, rule, verdict)``.

    ``rule`` is null where none fits, and the verdict is then ``default``. Null urls and urls without ``://`` have an
    empty host and path and no rule. Repeated rows stay repeated; null ids are kept; other columns are not read.
    """
    pages = pages.select("page_id", "url")
    found = matched_rules(pages, rules)
    return (
        pages.withColumn("url_id", _digest(F.col("url"))).join(found, "url_id", "left")
        .select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "rule", F.coalesce("rule_verdict", F.lit(default)).alias("verdict"))
    )

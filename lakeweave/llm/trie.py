"""Prefix trie of conversations, with totals of subtrees by a rollup over bands of depths.

A node is a sequence of first turns; its name is a digest that is built block by block, so that even a conversation that holds a third of all
rows is numbered, named and rolled up by many tasks. Bands are ``height`` depths high: a node hands its numbers to its ancestors
within the band only, and band roots, which form a trie ``height`` times lower, are rolled up the same way before their totals go to the band above.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeweave.llm.common import read_columns, stored

HEIGHT = 16  # depths of a band; a longest conversation of n turns takes log n to this base rounds
FAMILY, READ = 100, 6  # conversation c starts with crc32(c) % READ turns of conversation c - c % FAMILY
SLOT_BITS = 15  # ids of a slot are joined to one text: at most 2**15 of them
ROOT = hashlib.sha256(b"root").hexdigest()[:32]


def _digest(*parts: Column) -> Column:
    """128 bits of a SHA-256, in hexadecimal."""
    return F.left(F.sha2(F.concat(*parts), 256), F.lit(32))


def _struct(**fields: Column) -> Column:
    """A struct whose fields keep their names inside lambdas too."""
    return F.named_struct(*[x for name, value in fields.items() for x in (F.lit(name), value)])


# --- turns of the rebuilt conversations ----------------------------------------------------------


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``(conv, key, chars, at)``: turns by a digest of role and text, dealt by ranges so that ``at`` rises along each conversation.

    Ranges cut through conversations, and a last key cuts through equal rows, so no conversation is one task's work. Turn numbers order
    the turns, null first; equal ones are ordered by the digest.
    """
    rows = read_columns(conversations, "conv_id", "turn", "role", "text").where(F.col("conv_id").isNotNull())
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = rows.select(
        F.col("conv_id").cast("long").alias("conv"), "turn", _digest(F.length(role).cast("string"), F.lit(":"), role, text).alias("key"),
        F.length(text).cast("long").alias("chars"), F.monotonically_increasing_id().alias("row"),
    )
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("key"), F.col("row")]
    dealt = stored(turns, "turns").repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(dealt.select("conv", "key", "chars", F.monotonically_increasing_id().alias("at")), "turns-in-order")


def conversation_parts(turns: DataFrame) -> DataFrame:
    """One row per conversation and range that holds turns of it, with all that is needed to rebuild it.

    ``first`` and ``before``: smallest ``at`` in the range, and turns in earlier ranges. ``skip`` (h) turns are replaced by ``taken`` ones of the
    family's first conversation; ``depth`` is the length after that. ``readers`` (with the family's first conversation only) are the conversations that start with its turns: a
    family has fewer than 2 * FAMILY of them. ``slot`` numbers ranges of conversations in ascending order.
    """
    part = F.shiftright("at", 33)
    parts = turns.groupBy("conv", part.alias("part")).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    within = W.partitionBy("conv").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    convs = (
        parts.withColumn("before", F.coalesce(F.sum("n").over(within), F.lit(0)))
        .groupBy("conv").agg(F.sum("n").alias("size"), F.min("first").alias("start"), F.collect_list(F.struct("part", "first", "before")).alias("parts"))
        .withColumn("skip", F.crc32(F.col("conv").cast("string")) % READ).withColumn("family", F.col("conv") - F.col("conv") % FAMILY)
    )
    own = F.col("conv") == F.col("family")
    families = convs.groupBy("family").agg(
        F.coalesce(F.max(F.when(own, F.col("size"))), F.lit(0)).alias("base_size"),
        F.collect_list(F.struct("conv", "size", "skip", F.shiftright("start", SLOT_BITS).alias("slot"), "parts")).alias("members"),
    )
    taken = lambda m: F.least(m["skip"], F.col("base_size"))
    depth = lambda m: taken(m) + F.greatest(m["size"] - m["skip"], F.lit(0))
    readers = F.transform("members", lambda m: _struct(conv=m["conv"], skip=m["skip"], depth=depth(m), slot=m["slot"]))
    m = F.col("m")
    rebuilt = families.select("family", "base_size", readers.alias("readers"), F.explode("members").alias("m")).select(
        m["conv"].alias("conv"), m["skip"].alias("skip"), taken(m).alias("taken"), depth(m).alias("depth"), m["slot"].alias("slot"),
        F.when(m["conv"] == F.col("family"), F.col("readers")).alias("readers"), F.explode(m["parts"]).alias("p"),
    )
    near = F.when(F.col("p.before") < READ, F.col("readers"))
    return rebuilt.select("conv", "skip", "taken", "depth", "slot", near.alias("readers"), "p.part", "p.first", "p.before")


def rebuilt_turns(turns: DataFrame, parts: DataFrame) -> DataFrame:
    """``(conv, d, key, chars, slot)``: turn ``d`` (from 1) of every rebuilt conversation; ``slot`` is set at its last turn only."""
    joined = turns.withColumn("part", F.shiftright("at", 33)).join(parts, ["conv", "part"])
    joined = joined.withColumn("pos", F.col("before") + F.col("at") - F.col("first") + 1)
    pos = F.col("pos")
    kind = "array<struct<conv: long, d: long, depth: long, slot: long>>"
    own = F.when(pos > F.col("skip"), F.array(_struct(conv=F.col("conv"), d=F.col("taken") + pos - F.col("skip"), depth=F.col("depth"), slot=F.col("slot"))))
    read = F.when(
        (pos < READ) & F.col("readers").isNotNull(),
        F.transform(F.filter("readers", lambda r: r["skip"] >= pos), lambda r: _struct(conv=r["conv"], d=pos, depth=r["depth"], slot=r["slot"])),
    )
    none = F.array().cast(kind)
    uses = F.concat(F.coalesce(own.cast(kind), none), F.coalesce(read.cast(kind), none))
    t = F.col("t")
    return joined.select("key", "chars", F.explode(uses).alias("t")).select(
        t["conv"].alias("conv"), t["d"].alias("d"), "key", "chars", F.when(t["d"] == t["depth"], t["slot"]).alias("slot")
    )


# --- names of prefixes, by blocks of blocks --------------------------------------------------------


def _blocks(items: DataFrame, height: int) -> DataFrame:
    """Items ``(conv, d, key, chars, slot)`` in blocks of ``height`` consecutive ones."""
    block = F.expr(f"(d - 1) div {height}L")
    return items.groupBy("conv", block.alias("block")).agg(F.sort_array(F.collect_list(F.struct("d", "key", "chars"))).alias("items"), F.max("slot").alias("slot"))


def _paths(blocks: DataFrame, above: DataFrame | None, height: int) -> DataFrame:
    """Blocks with ``path``: the names of the prefixes before the block and after each of its items.

    The name before a block, and that after a full one, are names of the level above, where full blocks are the items.
    """
    full = F.size("items") == height
    first = blocks.where((F.col("block") == 0) & ~full).withColumns({"start": F.lit(ROOT), "next": F.lit(None).cast("string")})
    if above is not None:
        names = above.select("conv", "block", F.col("path").alias("p"), F.posexplode("path").alias("j", "start")).select(
            "conv", (F.col("block") * height + F.col("j")).alias("block"), "start", F.get("p", F.col("j") + 1).alias("next")
        )
        # The last name of a full block is also the first of the block after it, if there is one.
        names = names.groupBy("conv", "block").agg(F.max("start").alias("start"), F.max("next").alias("next"))
        first = first.unionByName(blocks.where((F.col("block") > 0) | full).join(names, ["conv", "block"]))
    keys = F.transform(F.slice("items", 1, height - 1), lambda i: i["key"])
    chain = F.aggregate(keys, F.array("start").cast("array<string>"), lambda path, key: F.concat(path, F.array(_digest(F.element_at(path, -1), key))).cast("array<string>"))
    path = F.when(full, F.concat(chain, F.array("next"))).otherwise(chain)
    return first.select("conv", "block", "slot", F.transform("items", lambda i: i["chars"]).alias("chars"), path.alias("path"))


def prefix_paths(turns: DataFrame, height: int) -> list[DataFrame]:
    """Paths of all levels, turns first. Level by level up, full blocks become items; level by level down, prefixes get their names."""
    levels = [stored(_blocks(turns, height), "blocks")]
    while True:
        full = levels[-1].where(F.size("items") == height)
        if full.isEmpty():
            break
        block = _digest(F.lit("block"), F.array_join(F.transform("items", lambda i: i["key"]), ""))
        items = full.select("conv", (F.col("block") + 1).alias("d"), block.alias("key"), F.lit(0).cast("long").alias("chars"), F.lit(None).cast("long").alias("slot"))
        levels.append(stored(_blocks(items, height), "blocks"))
    paths: list[DataFrame] = []
    for blocks in reversed(levels):
        paths.insert(0, stored(_paths(blocks, paths[0] if paths else None, height), "paths"))
    return paths


# --- nodes and totals --------------------------------------------------------------------------------


def _steps(paths: DataFrame) -> DataFrame:
    """One row per item of a block: its prefix ``name``, the ``parent`` before it, and ``line``, the names from the band's root to before the parent."""
    at = F.posexplode("chars").alias("j", "n_chars")
    return paths.select("conv", "block", "path", at).select(
        "conv", "block", "j", F.col("n_chars").alias("chars"), F.get("path", F.col("j") + 1).alias("name"), F.get("path", "j").alias("parent"),
        F.slice("path", F.lit(1), F.col("j")).alias("line"),
    )


def trie_nodes(paths: DataFrame, parts: DataFrame, height: int) -> DataFrame:
    """``(name, parent, depth, chars, line, n_convs, conv_id, n_children)`` of every node. Counted in part by each task first, so a hot first turn is one row per task."""
    steps = _steps(paths).withColumn("depth", F.col("block") * height + F.col("j") + 1)
    nodes = steps.groupBy("name", "parent", "depth", "chars", "line").agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv_id"))
    root = parts.where("before = 0").agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv_id")).where("n_convs > 0")
    root = root.select(
        F.lit(ROOT).alias("name"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("chars"),
        F.array().cast("array<string>").alias("line"), "n_convs", "conv_id",
    )
    nodes = stored(nodes.unionByName(root), "nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    return stored(nodes.join(children, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes-with-children")


def _summed(rows: DataFrame, to: Column) -> DataFrame:
    return rows.select(F.explode(to).alias("name"), "saved", "leaves").groupBy("name").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))


def band_totals(nodes: DataFrame, levels: list[DataFrame], height: int) -> DataFrame:
    """``(name, saved, leaves)`` summed over the subtree of every node of ``nodes (name, parent, line, k, saved, leaves)``, ``k`` being its depth at this level.

    ``levels`` are the paths of the levels above. A node hands its numbers to its line, its parent and itself, which lie in its band; a band
    root to itself. The roots' totals come from the level above, complete, and go to the nodes on their line in the band over them.
    """
    is_root = F.col("k") % height == 0
    line = F.concat("line", F.array("parent", "name"))
    inside = _summed(nodes, F.when(is_root, F.array("name")).otherwise(line))
    if not levels:
        return inside
    inside = stored(inside, "band-sums")
    steps = _steps(levels[0]).select("name", "parent", "line", (F.col("block") * height + F.col("j") + 1).alias("k")).distinct()
    top = nodes.where("k = 0").select("name", F.col("parent"), F.array().cast("array<string>").alias("line"), "k")
    roots = stored(band_totals(steps.unionByName(top).join(inside, "name"), levels[1:], height), "root-totals")
    below = nodes.where(is_root & (F.col("k") > 0)).select("name", "parent", "line").join(roots, "name")
    handed = _summed(below, F.slice(F.concat("line", F.array("parent")), 2, height))  # the first of the line is a root itself
    rest = inside.join(roots, "name", "left_anti").unionByName(handed)
    return rest.groupBy("name").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")).unionByName(roots)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows ``(name, slot, ids)`` of whole names to one SHA-256 per name, fed piece by piece."""
    name, state = None, None
    for batch in batches:
        names, hashes = [], []
        for new, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if new != name:
                if name is not None:
                    names.append(name)
                    hashes.append(state.hexdigest())
                name, state = new, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(hashes, pa.string())], ["name", "ends_sha256"])
    if name is not None:
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([state.hexdigest()])], ["name", "ends_sha256"])


def end_digests(paths: DataFrame, parts: DataFrame) -> DataFrame:
    """``(name, ends_sha256)``: digest of the conversations that end at a node, for nodes that have any.

    Ids are joined to texts slot by slot, so that many conversations that are all alike become few rows before they meet in one hash.
    """
    ends = paths.where("slot is not null").select(F.element_at("path", -1).alias("name"), "conv", "slot")
    ends = ends.unionByName(parts.where("before = 0 and depth = 0").select(F.lit(ROOT).alias("name"), "conv", "slot"))
    ids = F.array_join(F.array_sort(F.collect_list("conv")).cast("array<string>"), ",")
    texts = ends.groupBy("name", "slot").agg(ids.alias("ids"))
    return texts.repartition("name").sortWithinPartitions("name", "slot").mapInArrow(_hashed, "name string, ends_sha256 string")


@dataclass(frozen=True)
class Trie:
    """Nodes, totals of their subtrees, and digests of the conversations that end at them."""

    nodes: DataFrame
    totals: DataFrame
    ends: DataFrame


def build_trie(conversations: DataFrame, height: int = HEIGHT) -> Trie:
    """The trie of all rebuilt conversations, its tables stored step by step in the shared folder."""
    turns = numbered_turns(conversations)
    parts = stored(conversation_parts(turns), "conversations")
    paths = prefix_paths(rebuilt_turns(turns, parts), height)
    nodes = trie_nodes(paths[0], parts, height)
    weights = nodes.select(
        "name", "parent", "line", F.col("depth").alias("k"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"), F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves")
    )
    return Trie(nodes, band_totals(weights, paths[1:], height), end_digests(paths[0], parts))


def prefix_trie(conversations: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Every node of the trie of rebuilt conversations: ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``.

    Conversation c consists of the first ``crc32(c) % 6`` turns of conversation ``c - c % 100`` (of a negative c: towards zero) and of its own turns after
    as many. Turns are ordered by ``turn``, null first, equal ones by a digest of role and text; repeated rows are turns of their own.
    Null roles and texts are empty. Rows without ``conv_id`` belong to no conversation. An empty table has no node, not even a root. Other
    columns are not read.
    """
    trie = build_trie(conversations, height)
    parents = trie.nodes.where("n_children > 0").select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        trie.nodes.select("name", "parent", "depth", "n_convs", "conv_id", "n_children")
        .join(parents, "parent", "left").join(trie.totals, "name").join(trie.ends, "name", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )

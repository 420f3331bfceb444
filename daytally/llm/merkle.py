"""Merkle trees over the rows of a table: a root for each group and one for all groups.

A leaf is the hash of a row's columns. Within a group leaves stand in order of their key;
two neighbours at a time (a last one alone) become the hash of their digests, level by
level. Nodes are dealt into aligned blocks of BLOCK, each a row: a level of it is one string
of hex digests of fixed width, whose parents are the hashes of its substrings; the substrings
beside a node are its siblings. The tops of a group's blocks are the nodes of the next round,
until one is left; then the groups' subroots are nodes of a last tree.

Places come from counts: the leaves are sorted over all tasks by (group, key, leaf) and each
task's share of a group is counted, so no group need fit into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daytally.llm.common import written

#: Digits of a digest.
WIDTH = 64
#: Levels of a block, and the nodes that it has at the lowest.
LEVELS = 8
BLOCK = 1 << LEVELS
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def hashed(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def framed(value: Column) -> Column:
    """A value as a leaf has it: ``-`` if null, else its count of UTF-8 bytes, ``:`` and itself."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*columns: Column) -> Column:
    return hashed(*map(framed, columns))


def placed(leaves: DataFrame) -> DataFrame:
    """A written table ``leaves`` (group, key, digest, ...) with ``n``, the number of rows of
    their group, and ``place`` among them, from 0, by key and digest. The rows are sorted over
    all tasks; equal ones are told apart by where they stand, so they do not share a task."""
    order = ("group", "key", "digest", "_tie")
    ordered = leaves.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    # The upper bits of the id are the task's number, in the order of the ranges; the lower
    # bits count its rows.
    numbered = written(ordered.withColumn("_id", F.monotonically_increasing_id()).drop("_tie"), "ordered")
    numbered = numbered.withColumn("_task", F.shiftright("_id", 33))
    counts = numbered.groupBy(F.col("group").alias("_group"), F.col("_task").alias("_part")).agg(F.min("_id").alias("_first"), F.count("*").alias("_rows"))
    whole = Window.partitionBy("_group")
    before = F.sum("_rows").over(whole.orderBy("_part")) - F.col("_rows")
    counts = counts.select("_group", "_part", "_first", before.alias("_before"), F.sum("_rows").over(whole).alias("n"))
    joined = numbered.join(counts, F.col("group").eqNullSafe(F.col("_group")) & (F.col("_task") == F.col("_part")))
    return joined.select(*leaves.columns, "n", (F.col("_before") + F.col("_id") - F.col("_first")).alias("place"))


def _digest(level: Column, place: Column) -> Column:
    """The digest at a place, empty outside of the level."""
    return F.substring(level, (place * WIDTH + 1).cast("int"), F.lit(WIDTH))


def _parents(level: Column, wanted: Column) -> Column:
    """The level above, of a level that has more than one node or is not yet at the top."""
    pairs = F.sequence(F.lit(0), F.ceil(F.octet_length(level) / (2 * WIDTH)).cast("int") - 1)
    above = F.array_join(F.transform(pairs, lambda i: F.sha2(F.substring(level, i * 2 * WIDTH + 1, F.lit(2 * WIDTH)), 256)), "")
    return F.when(wanted, above.cast("binary")).otherwise(level)


def _flank(level: Column, place: Column) -> Column:
    """The digests left and right of a node in its pair; one of them is always empty."""
    is_right = place % 2 == 1
    return F.struct(
        F.when(is_right, _digest(level, place - 1)).otherwise(F.lit(b"")).cast("string").alias("left"),
        F.when(is_right, F.lit(b"")).otherwise(_digest(level, place + 1)).cast("string").alias("right"),
    )


def _rises(level: int) -> Column:
    """Whether a block's nodes of this level have parents in it: all blocks of a group that
    has several rise LEVELS; a group of one block ends at its single node."""
    return (F.col("n") > BLOCK) | (F.col("n") > (1 << level))


def _blocks(nodes: DataFrame) -> DataFrame:
    """A row for each block of ``nodes`` (group, place, n, digest, item): its ``items`` with
    their places, its levels, each a string, and its ``top``."""
    block = F.floor(F.col("place") / BLOCK).cast("long")
    held = F.sort_array(F.collect_list(F.struct("place", "digest", "item")))
    blocks = nodes.groupBy("group", "n", block.alias("block")).agg(held.alias("held"))
    items = F.transform("held", lambda e: F.struct(e["place"].alias("place"), e["item"].alias("item")))
    blocks = blocks.select("group", "n", "block", items.alias("items"), F.array_join("held.digest", "").cast("binary").alias("level0"))
    for i in range(LEVELS):
        blocks = blocks.withColumn(f"level{i + 1}", _parents(F.col(f"level{i}"), _rises(i)))
    return blocks.withColumn("top", F.col(f"level{LEVELS}").cast("string"))


def climb(nodes: DataFrame) -> list[DataFrame]:
    """The blocks of each round, written, from ``nodes`` up; the last has one a group."""
    rounds = [written(_blocks(nodes), "blocks")]
    most = rounds[0].agg(F.max("n")).first()[0] or 0
    while most > BLOCK:
        most = -(-most // BLOCK)
        n = F.ceil(F.col("n") / BLOCK).cast("long")
        above = rounds[-1].select("group", F.col("block").alias("place"), n.alias("n"), F.col("top").alias("digest"), F.lit(None).cast("int").alias("item"))
        rounds.append(written(_blocks(above), "blocks"))
    return rounds


def _segments(blocks: DataFrame, *carried: str) -> DataFrame:
    """The items of blocks with their siblings, lowest first: those in the block, then ``_above``."""

    def one(e: Column) -> Column:
        inner = e["place"] % BLOCK
        own = F.array(*[F.when(_rises(i), _flank(F.col(f"level{i}"), F.shiftright(inner, i))) for i in range(LEVELS)])
        siblings = F.concat(F.filter(own, lambda s: s.isNotNull()), "_above")
        digest = _digest(F.col("level0"), inner).cast("string")
        return F.struct(e["place"].alias("place"), e["item"].alias("item"), digest.alias("digest"), siblings.alias("siblings"))

    return blocks.select("group", F.explode(F.transform("items", one)).alias("e"), *carried).select("group", "e.*", *carried)


def descend(rounds: list[DataFrame], above: DataFrame, *carried: str) -> DataFrame:
    """(group, place, item, digest, siblings) of each node of the lowest round, and the columns
    ``carried`` of ``above`` (_group, _above: the siblings over the group's own root)."""
    found = _segments(rounds[-1].join(above, F.col("group").eqNullSafe(F.col("_group"))), *carried)
    for blocks in rounds[-2::-1]:
        above = found.select(F.col("group").alias("_group"), F.col("place").alias("_block"), F.col("siblings").alias("_above"), *carried)
        found = _segments(blocks.join(above, F.col("group").eqNullSafe(F.col("_group")) & (F.col("block") == F.col("_block"))), *carried)
    return found


def proof(siblings: Column) -> Column:
    """The hash of all siblings, left to right and from the leaf to the root."""
    return F.sha2(F.array_join(F.transform(siblings, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(digest: Column, siblings: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(siblings, digest, lambda below, s: hashed(s["left"], below, s["right"]))


def manifest(
    docs: DataFrame, changed: Column | None = None, columns: tuple[str, ...] = COLUMNS, key: str = "doc_id", group: str = "lang"
) -> DataFrame:
    """(key, group, leaf, subroot, root, siblings, seen): a row for each row of ``docs``.

    ``siblings`` lead from ``leaf`` by its group's ``subroot`` to the ``root`` of all groups,
    which are ordered by the group's bytes, null first (see :func:`folded`). ``seen`` is the
    leaf that is checked against the manifest: that of the row as ``changed``, a struct of
    the same columns, has it, or the leaf itself.

    Nulls in any column count as ``-`` in a leaf; null keys come first and null groups are
    one. Empty and very long texts are hashed whole. Rows with one key are ordered by leaf;
    repeated rows are leaves of their own, next to each other. An empty table gives an empty
    result. Names of other columns do not matter, and they do not pass. Texts are read once
    and do not shuffle; digests shuffle three times, spread evenly whatever the groups' sizes.
    """
    own = leaf(*(F.col(f"`{c}`") for c in columns))
    seen = F.lit(None).cast("string") if changed is None else F.when(changed.isNotNull(), leaf(*(changed[c] for c in columns)))
    leaves = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{group}`").alias("group"), own.alias("digest"), seen.alias("seen"))
    nodes = placed(written(leaves, "leaves"))
    rounds = climb(nodes.select("group", "place", "n", "digest", F.struct("key", "seen").alias("item")))

    tops = rounds[-1].select(F.lit(0).alias("group"), F.col("group").alias("key"), F.col("top").alias("digest"))
    upper = climb(placed(tops).select("group", "place", "n", "digest", F.col("key").alias("item")))
    none = F.array().cast("array<struct<left:string,right:string>>")
    groups = descend(upper, upper[-1].select(F.col("group").alias("_group"), none.alias("_above"), F.col("top").alias("root")), "root")
    above = groups.select(F.col("item").alias("_group"), F.col("siblings").alias("_above"), F.col("digest").alias("subroot"), "root")

    rows = descend(rounds, above, "subroot", "root")
    seen = F.coalesce("item.seen", "digest")
    return rows.select(F.col("item.key").alias(key), F.col("group").alias(group), F.col("digest").alias("leaf"), "subroot", "root", "siblings", seen.alias("seen"))


def verified(rows: DataFrame) -> DataFrame:
    """``rows`` of a manifest with ``proof_sha256``, ``folded_root`` and ``verified``: whether
    the leaf that was seen leads to the root."""
    return rows.withColumns({"proof_sha256": proof(F.col("siblings")), "folded_root": folded(F.col("seen"), F.col("siblings"))}).withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )

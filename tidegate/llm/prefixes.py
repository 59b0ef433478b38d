"""Prefix trie of conversations, by digests of fixed-length blocks of turns.

A conversation is cut into blocks of ``BLOCK`` turns. A block's place is named by a key of all blocks before it:
each full block gives a digest of its number and turns, and the key is made of the sums of these digests, so it
comes from prefix sums and not from a chain, in parts of ``SPAN`` blocks for conversations of any length.
Conversations are grouped by (key before the block, key after it) first; only where the conversations behind one
key go on with different blocks are blocks opened, and their turns grouped one by one. A block without siblings
gives its nodes as they are.

Sums over subtrees need no walk from leaf to root. A node's smallest member stands for it; a conversation stands
for the end of its path, all nodes from some depth on. So the distinct nodes below a node are those that its
members stand for, and leaves, words of all members and words of distinct nodes are plain sums over members, less
what lies above the node on its own path.

``rebuilt`` first replaces the beginning of conversations by that of others. Results for special inputs: turns
count in order of ``turn``, null first, ties by a digest of role and text; null role or text is empty; rows
without id belong to no conversation; repeated rows are turns of their own; conversations without turns end at the
root; texts of any length count whole; an empty table gives an empty result; other columns are ignored. Rows of one
conversation whose ``turn`` is the same but for its last ``TURN_BITS`` bits are numbered by one task, rows without
turn by 256. Ids are integers.

Turns, blocks and nodes are told apart by 128 bits of SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.common import cut, work_folder
from tidegate.operators.positions import dense_positions

#: Turns of a block, blocks whose sums one task runs over, ids of one part of a list of members.
BLOCK, SPAN, IDS = 4, 1024, 256
TURN_BITS = 8
#: Conversations share beginnings within groups of this many ids, of 0 to MOST_SHARED turns.
GROUP, MOST_SHARED = 20, 3
WORD = r"[^\x20\x09-\x0D]+"
PIECES = [f"p{i}" for i in range(4)]


def _name(*parts: Column) -> Column:
    """128 bits, in hexadecimal digits."""
    return F.substring(F.sha2(F.concat_ws("/", *parts).cast("binary"), 256), 1, 32)


def _key(block: Column, sums: list[Column]) -> Column:
    return _name(F.lit("block"), block.cast("string"), *[s.cast("string") for s in sums])


def _root() -> Column:
    return _key(F.lit(0), [F.lit(0)] * len(PIECES))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, turn, words): every turn with its place from 0, a digest and its number of words."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("at"),
        _name(F.length(role).cast("string"), role, text).alias("turn"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    part = F.struct(
        F.floor(F.col("at") / (1 << TURN_BITS)).alias("at"),
        F.when(F.col("at").isNull(), F.substring("turn", 1, 2)).alias("turn"),
    )
    placed = dense_positions(turns, ["conv_id"], [F.asc_nulls_first("at"), F.asc("turn")], part, "place")
    return placed.select("conv_id", (F.col("place") - 1).alias("place"), "turn", "words")


def rebuilt(turns: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the first of their group of ids: (conv_id, size) and their turns, numbered anew.

    A conversation c takes the first h turns of c - c % GROUP, h = crc32(c) % (MOST_SHARED + 1), and goes on with
    its own turns after its first h.
    """
    sizes = cut(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")), folder, "sizes")
    shared = (F.crc32(F.col("conv_id").cast("string")) % (MOST_SHARED + 1)).alias("shared")
    named = sizes.select("conv_id", "own", shared, (F.col("conv_id") - F.col("conv_id") % GROUP).alias("leader"))
    led = named.join(sizes.select(F.col("conv_id").alias("leader"), F.col("own").alias("there")), "leader", "left")
    taken = F.least("shared", F.coalesce("there", F.lit(0)))
    rest = F.greatest(F.col("own") - F.col("shared"), F.lit(0))
    named = cut(led.select("conv_id", "leader", "shared", taken.alias("taken"), (taken + rest).alias("size")), folder, "named")

    first = turns.where(F.col("place") < MOST_SHARED).select(F.col("conv_id").alias("leader"), "place", "turn", "words")
    begin = named.join(first, "leader").where(F.col("place") < F.col("taken"))
    go_on = turns.join(named, "conv_id").where(F.col("place") >= F.col("shared"))
    moved = (F.col("place") - F.col("shared") + F.col("taken")).alias("place")
    every = begin.select("conv_id", "place", "turn", "words", "size").unionByName(
        go_on.select("conv_id", moved, "turn", "words", "size")
    )
    return named.select("conv_id", "size"), every


def blocks(turns: DataFrame, folder: str) -> DataFrame:
    """One row per conversation and block: keys before and after it, its turns, words before it, whether it is the last.

    The key after a full block is the key before the next one; a block that is not full ends in a node of its own.
    """
    number = F.floor(F.col("place") / BLOCK)
    listed = F.array_sort(F.collect_list(F.struct("place", "turn", "words")))
    grouped = turns.groupBy("conv_id", number.alias("block")).agg(listed.alias("turns"), F.max("size").alias("size"))
    names = F.array_join(F.col("turns.turn"), "/")
    digest = F.sha2(F.concat_ws("/", F.col("block").cast("string"), names).cast("binary"), 256)
    grouped = grouped.withColumn("digest", digest)
    for i, piece in enumerate(PIECES):  # 32 bits each, so that sums of two billion blocks fit
        grouped = grouped.withColumn(piece, F.conv(F.substring("digest", 1 + 8 * i, 8), 16, 10).cast("long"))
    count = F.aggregate("turns.words", F.lit(0).cast("long"), lambda a, b: a + b)
    grouped = grouped.withColumn("words", count).withColumn("span", F.floor(F.col("block") / SPAN))
    grouped = cut(grouped.drop("digest"), folder, "grouped")

    summed = [*PIECES, "words"]
    before = Window.partitionBy("conv_id", "span").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inner = grouped.select("*", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"in_{c}") for c in summed])
    spans = grouped.groupBy("conv_id", "span").agg(*[F.sum(c).alias(c) for c in summed])
    earlier = Window.partitionBy("conv_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("conv_id", "span", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"up_{c}") for c in summed])
    both = inner.join(spans, ["conv_id", "span"])
    starts = [F.col(f"in_{c}") + F.col(f"up_{c}") for c in PIECES]
    ends = [start + F.col(c) for start, c in zip(starts, PIECES, strict=True)]
    key = _key(F.col("block"), starts)
    after = F.when(F.size("turns") == BLOCK, _key(F.col("block") + 1, ends)).otherwise(_name(key, names))
    last = F.col("block") == F.floor((F.col("size") - 1) / BLOCK)
    return both.select(
        "conv_id",
        "block",
        key.alias("key"),
        after.alias("after"),
        "turns",
        (F.col("in_words") + F.col("up_words")).alias("above"),
        "words",
        last.alias("last"),
    )


def _opened(classes: DataFrame) -> DataFrame:
    """One row per class and turn: the node it leads to and the node before, its depth, words and words above."""
    places = F.sequence(F.lit(1), F.size("turns"))
    each = classes.select("*", F.explode(places).alias("i"))
    count = F.size("turns")

    def inside(i: Column) -> Column:
        return _name(F.col("key"), F.array_join(F.slice(F.col("turns.turn"), F.lit(1), i), "/"))

    node = F.when(F.col("i") == count, F.col("after")).otherwise(inside(F.col("i")))
    parent = F.when(F.col("i") == 1, F.col("key")).otherwise(inside(F.col("i") - 1))
    earlier = F.aggregate(
        F.slice(F.col("turns.words"), F.lit(1), F.col("i") - 1), F.lit(0).cast("long"), lambda a, b: a + b
    )
    return each.select(
        node.alias("node"),
        parent.alias("parent"),
        (F.col("block") * BLOCK + F.col("i")).alias("depth"),
        F.element_at("turns.words", F.col("i")).alias("words"),
        (F.col("above") + earlier).alias("above"),
        *[c for c in classes.columns if c not in ("key", "after", "turns", "block", "above", "words", "i")],
    )


def _spread(classes: DataFrame, sums: dict[str, str]) -> DataFrame:
    """Nodes of classes: as they are where a class is alone behind its key, grouped by turn where it has siblings."""
    fixed = ["parent", "depth", "words", "above"]
    alone = _opened(classes.where("siblings = 1").drop("siblings"))
    opened = _opened(classes.where("siblings > 1").drop("siblings"))
    merged = [*[F.min(c).alias(c) for c in fixed], *[F.expr(f"{how}({c})").alias(c) for c, how in sums.items()]]
    return alone.unionByName(opened.groupBy("node").agg(*merged))


def _id_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of (node, conv_id): digests of the ids in order, gathered in parts of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            names, digests = [], []
            for name, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if name != node:
                    if node is not None:
                        names.append(node)
                        digests.append(state.hexdigest())
                    node, state = name, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(digests, pa.string())], ["node", "ends"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([state.hexdigest()])], ["node", "ends"])

    part = F.floor(F.col("conv_id") / IDS).alias("part")
    ids = F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",")
    parts = ends.groupBy("node", part).agg(ids.alias("ids"))
    ordered = parts.repartition("node").sortWithinPartitions("node", "part").select("node", "ids")
    return ordered.mapInArrow(run, "node string, ends string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Every node of the trie of rebuilt conversations, named by its smallest member and its depth.

    n_convs, n_children, n_leaves and saved_tokens (words that need not be read again below the node, when every
    distinct turn is read once) are counts; ends_sha256 is the digest of the ids that end there.
    """
    folder = work_folder(conversations.sparkSession)
    turns = cut(numbered_turns(conversations), folder, "turns")
    named, every = rebuilt(turns, folder)
    pieces = cut(blocks(every, folder), folder, "blocks")

    same = pieces.groupBy("key", "after").agg(
        F.count(F.lit(1)).alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.any_value("turns").alias("turns"),
        F.min("block").alias("block"),
        F.min("above").alias("above"),
    )
    same = cut(same, folder, "same")
    siblings = cut(same.groupBy("key").agg(F.count(F.lit(1)).alias("siblings")), folder, "siblings")
    classes = cut(same.join(siblings, "key"), folder, "classes")
    root = named.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    zero = F.lit(0).cast("long")
    root = root.select(
        _root().alias("node"),
        F.lit(None).cast("string").alias("parent"),
        *[zero.alias(c) for c in ("depth", "words", "above")],
        "n_convs",
        "conv_id",
    )
    nodes = _spread(classes, {"n_convs": "sum", "conv_id": "min"})
    nodes = cut(nodes.unionByName(root.select(nodes.columns)), folder, "nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node"))
    children = cut(children.agg(F.count(F.lit(1)).alias("n_children")), folder, "children")

    # What each conversation stands for: its words in all, those of its own nodes, words above them, and its leaf.
    own = nodes.groupBy("conv_id").agg(F.sum("words").alias("own_words"), F.min("above").alias("own_above"))
    leaves = nodes.join(children, "node", "left_anti").select("conv_id", F.lit(1).cast("long").alias("leaf"))
    totals = pieces.where("last").select("conv_id", (F.col("above") + F.col("words")).alias("all_words"))
    worth = named.join(totals, "conv_id", "left").join(own, "conv_id", "left").join(leaves, "conv_id", "left")
    counted = ["all_words", "own_words", "leaf"]
    worth = worth.select("conv_id", "own_above", *[F.coalesce(c, zero).alias(c) for c in counted])
    worth = cut(worth, folder, "worth")
    added = [F.sum(c).alias(c) for c in counted]
    summed = pieces.select("conv_id", "key", "after").join(worth, "conv_id").groupBy("key", "after").agg(*added)
    summed = classes.drop("n_convs", "conv_id").join(summed, ["key", "after"])
    below = _spread(summed, {c: "sum" for c in counted}).select("node", *counted)
    below = below.unionByName(worth.agg(*added).select(_root().alias("node"), *counted))

    ends = pieces.where("last").select(F.col("after").alias("node"), "conv_id")
    ends = ends.unionByName(named.where("size = 0").select(_root().alias("node"), "conv_id"))
    facts = _gathered([nodes, children, below, _id_digests(ends)]).where("n_convs is not null")
    facts = cut(facts, folder, "facts")
    # Joined from written tables, so that a parent of very many nodes can be split.
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    stand = worth.select("conv_id", "own_above")
    found = facts.join(parents, "parent", "left").join(stand, "conv_id")
    shared = F.col("all_words") - F.col("n_convs") * F.col("above")
    distinct = F.col("own_words") - (F.col("above") - F.col("own_above"))
    return found.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", zero).alias("n_children"),
        F.col("leaf").alias("n_leaves"),
        (shared - distinct).alias("saved_tokens"),
        F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def _gathered(sides: list[DataFrame]) -> DataFrame:
    """One row per node with what each side says about it; every side has a node once at most."""
    columns = list(dict.fromkeys(c for side in sides for c in side.columns if c != "node"))
    union = sides[0]
    for side in sides[1:]:
        union = union.unionByName(side, allowMissingColumns=True)
    return union.groupBy("node").agg(*[F.max(c).alias(c) for c in columns])

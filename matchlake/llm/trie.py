"""The prefix trie of conversations: what they share from their first turn on.

A prefix is known by a digest, the XOR over its turns of a 128-bit hash of (place, digest of role
and text), so all prefixes of a conversation are running totals (``scan``). A count-min sketch of
all prefixes is asked first: its counters never fall short, so a prefix counted once belongs to
one conversation. Such tails need no partner and are emitted where they are: one member, one leaf,
nothing saved. Only prefixes that may be shared are shuffled and grouped exactly.

Totals over a node's subtree go along conversations. Each node is written down once, at its
smallest member. A conversation's running totals from its end tell what it brings into the subtree
of each of its prefixes, and a node adds up what its members bring.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm import scan, sketch
from matchlake.llm.common import Scratch

NODE = ["depth", "lo", "hi"]
PARENT = ["up_depth", "up_lo", "up_hi"]
COUNTS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
COLUMNS = ["conv_id", "depth", "parent_conv_id", *COUNTS, "ends_sha256"]
#: Ids that are put together into one piece of text.
IDS_PER_PIECE = 2_000
#: The query's rebuilding: heads of the conversation that begins the five, 0 to 8 turns of it.
GROUP, HEADS = 5, 9


def _numbered(turns: DataFrame, scratch: Scratch, rows_per_block: int) -> DataFrame:
    """(conv, depth, turn_hash, size): turns by their place, from 1."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    narrow = turns.select(
        F.col("`conv_id`").cast("long").alias("conv"),
        F.col("`turn`").alias("turn"),
        F.unhex(F.sha2(whole, 256)).alias("turn_hash"),
        F.octet_length(text).cast("long").alias("size"),
    ).filter("conv IS NOT NULL")
    order = ["turn", "turn_hash"]
    placed = scan.place(narrow, ["conv", *order], turns.count(), scratch, "turns", rows_per_block)
    numbered = scan.running(placed, "conv", order, {"depth": (scan.SUM, F.lit(1))})
    return scratch.save(numbered.select("conv", F.col("depth").cast("int"), "turn_hash", "size"), "numbered")


def _plain(numbered: DataFrame, scratch: Scratch, hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """Turns as they are, and the conversations: (conv, len)."""
    convs = scratch.save(numbered.groupBy("conv").agg(F.max("depth").alias("len")), "convs")
    rows = sketch.attach(numbered, convs.withColumn("_n", F.col("len")), ["conv"], "_n", "inner", hot_rows)
    return rows.withColumn("last", F.col("depth") == F.col("len")).drop("len"), convs


def head_turns(conv: Column) -> Column:
    """How many turns a conversation takes from the first of its group."""
    return (F.crc32(conv.cast("string").cast("binary")) % HEADS).cast("int")


def _rebuilt(numbered: DataFrame, scratch: Scratch, hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """Turns of the conversations rebuilt: the first turns of another one, then their own rest.

    Conversation c takes the first h = crc32(c) % 9 turns of conversation c - c % 5.
    """
    conv = F.col("conv")
    lengths = scratch.save(numbered.groupBy("conv").agg(F.max("depth").alias("own")), "lengths")
    firsts = lengths.filter(conv % GROUP == 0).select(
        conv.alias("head"), F.least("own", F.lit(HEADS - 1)).alias("there")
    )
    # a head serves at most five conversations
    asked = lengths.withColumn("head", conv - conv % GROUP).withColumn("h", head_turns(conv))
    taken = F.least("h", F.coalesce("there", F.lit(0)))
    facts = asked.join(firsts, "head", "left").withColumn("taken", taken)
    length = F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    facts = scratch.save(facts.select("conv", "head", "own", "h", "taken", length.alias("len")), "convs")

    opening = numbered.filter((conv % GROUP == 0) & (F.col("depth") < HEADS)).withColumnRenamed("conv", "head")
    takers = facts.filter("taken > 0").select("head", "conv", "taken", "len")
    heads = opening.join(takers, "head").filter("depth <= taken")
    rest = numbered.filter(F.col("depth") > head_turns(conv))
    moves = facts.select("conv", "taken", "h", "len", F.col("own").alias("_n"))
    tails = sketch.attach(rest, moves, ["conv"], "_n", "inner", hot_rows)
    tails = tails.withColumn("depth", F.col("taken") + F.col("depth") - F.col("h"))
    columns = ["conv", "depth", "turn_hash", "size", (F.col("depth") == F.col("len")).alias("last")]
    return heads.select(*columns).unionByName(tails.select(*columns)), facts.select("conv", "len")


def _prefixes(rows: DataFrame, scratch: Scratch, rows_per_block: int, pages_mb: int) -> tuple[DataFrame, int]:
    """Every prefix but the empty one: its digest, its parent's, and whether each may be shared."""
    piece = lambda seed: F.xxhash64(F.lit(seed), "depth", "turn_hash")
    pieces = scratch.save(
        rows.select("conv", "depth", "size", "last", piece(0).alias("lo_piece"), piece(1).alias("hi_piece")), "pieces"
    )
    count = pieces.count()
    placed = scan.place(pieces, ["conv", "depth"], count, scratch, "pieces-placed", rows_per_block)
    values = {"lo": (scan.XOR, F.col("lo_piece")), "hi": (scan.XOR, F.col("hi_piece"))}
    summed = scan.running(placed, "conv", ["depth"], values).select(
        "conv",
        "size",
        "last",
        *NODE,
        (F.col("depth") - 1).alias("up_depth"),
        F.col("lo").bitwiseXOR(F.col("lo_piece")).alias("up_lo"),
        F.col("hi").bitwiseXOR(F.col("hi_piece")).alias("up_hi"),
    )
    digests = scratch.save(summed, "digests")
    length = sketch.row_length(count, pages_mb)
    pages = sketch.repeated_pages(digests, NODE, length, scratch, "sketch")
    asked = sketch.flag_repeated(digests, NODE, pages, length, "shared")
    asked = sketch.flag_repeated(asked, PARENT, pages, length, "up_asked")
    # the root belongs to all
    flagged = asked.withColumn("up_shared", F.col("up_asked") | (F.col("up_depth") == 0)).drop("up_asked")
    return scratch.save(flagged, "prefixes"), count


def _stream_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces of text to one digest per node; one node is open at a time."""
    node, digest = None, None

    def emit(key: tuple, value: str) -> pa.RecordBatch:
        arrays = [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int64()), pa.array([key[2]], pa.int64())]
        return pa.RecordBatch.from_arrays([*arrays, pa.array([value])], names=[*NODE, "ends_sha256"])

    for batch in batches:
        done = []
        for *key, piece in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
            if key != node:
                if node is not None:
                    done.append(emit(node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(piece.encode())
            else:
                digest.update(b"," + piece.encode())
        if done:
            yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
    if node is not None:
        yield emit(node, digest.hexdigest())


def _ends(members: DataFrame, rows: int, scratch: Scratch, rows_per_block: int) -> DataFrame:
    """(depth, lo, hi, ends_sha256) of the conversations that end at a node, by ascending id.

    Ids are put together into short pieces of text in ranges of (node, id), so a node with many ends
    is many tasks' work; only its pieces, in order, go through one digest, which has no other way.
    """
    placed = scan.place(members.select(*NODE, "conv"), [*NODE, "conv"], rows, scratch, "ends", rows_per_block)
    number = F.row_number().over(Window.partitionBy("_block", *NODE).orderBy("conv"))
    chunk = F.expr(f"(_n - 1) div {IDS_PER_PIECE}")
    pieces = (
        placed.withColumn("_n", number)
        .groupBy(*NODE, "_block", chunk.alias("_chunk"))
        .agg(F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("piece"))
    )
    dealt = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "_block", "_chunk")
    return dealt.select(*NODE, "piece").mapInArrow(
        _stream_digests, "depth int, lo long, hi long, ends_sha256 string"
    )


def _nodes(
    rows: DataFrame, convs: DataFrame, scratch: Scratch, rows_per_block: int, pages_mb: int, hot_rows: int
) -> DataFrame:
    """All nodes of the trie of ``rows`` (conv, depth, turn_hash, size, last)."""
    prefixes, count = _prefixes(rows, scratch, rows_per_block, pages_mb)
    nothing = F.lit(0).cast("long")
    zero = F.lit(0)
    root = convs.select(
        "conv",
        nothing.alias("size"),
        (F.col("len") == 0).alias("last"),
        zero.alias("depth"),
        nothing.alias("lo"),
        nothing.alias("hi"),
        F.lit(-1).alias("up_depth"),
        nothing.alias("up_lo"),
        nothing.alias("up_hi"),
        F.lit(False).alias("up_shared"),
    )
    single = prefixes.filter(~F.col("shared"))
    members = prefixes.filter("shared").drop("shared").unionByName(root)
    own = scratch.save(
        members.groupBy(*NODE).agg(
            F.min("conv").alias("conv"),
            F.count(F.lit(1)).alias("n_convs"),
            F.count_if("last").alias("n_ends"),
            F.max("size").alias("size"),
        ),
        "nodes",
    )

    # what every conversation brings, at which depth
    def brings(frame: DataFrame, depth: Column, saved: Column = nothing, leaf: Column = nothing, child: Column = nothing):
        return frame.select(
            "conv",
            depth.cast("int").alias("depth"),
            saved.alias("saved"),
            leaf.cast("long").alias("leaf"),
            child.cast("long").alias("child"),
        )

    depth, one = F.col("depth"), F.lit(1)
    parts = [
        brings(own, depth, (F.col("n_convs") - 1) * F.col("size"), F.col("n_convs") == F.col("n_ends")),
        brings(own.filter("depth > 0"), depth - 1, child=one),
        brings(single.filter("up_shared"), depth - 1, child=one),
        brings(single.filter("last"), depth, leaf=one),
    ]
    facts = ["lo", "hi", "size", "last", *PARENT, "up_shared"]
    united = members.select("conv", "depth", *facts, *[nothing.alias(c) for c in ("saved", "leaf", "child")])
    for part in parts:
        united = united.unionByName(part, allowMissingColumns=True)
    gathered = united.groupBy("conv", "depth").agg(
        *[F.max(c).alias(c) for c in facts], *[F.sum(c).alias(c) for c in ("saved", "leaf", "child")]
    )
    climbing = gathered.withColumn("rise", -depth)
    placed = scan.place(climbing, ["conv", "rise"], count + convs.count(), scratch, "paths", rows_per_block)
    totals = {"leaves": (scan.SUM, F.col("leaf")), "saves": (scan.SUM, F.col("saved"))}
    paths = scan.running(placed, "conv", ["rise"], totals).filter("lo IS NOT NULL")
    shared = scratch.save(
        paths.groupBy(*NODE).agg(
            F.min("conv").alias("conv"),
            *[F.max(c).alias(c) for c in (*PARENT, "up_shared")],
            F.count(F.lit(1)).alias("n_convs"),
            F.sum("child").alias("n_children"),
            F.sum("leaves").alias("n_leaves"),
            F.sum("saves").alias("saved_tokens"),
        ),
        "shared",
    )

    none = F.sha2(F.lit("").cast("binary"), 256)
    ends = _ends(members.filter("last"), convs.count(), scratch, rows_per_block)
    whole = shared.join(ends, NODE, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", none))
    id_hash = F.sha2(F.col("conv").cast("string").cast("binary"), 256)
    tails = single.select(
        *NODE,
        "conv",
        *PARENT,
        "up_shared",
        F.lit(1).cast("long").alias("n_convs"),
        F.when(F.col("last"), 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        nothing.alias("saved_tokens"),
        F.when(F.col("last"), id_hash).otherwise(none).alias("ends_sha256"),
    )
    # the parent of a prefix that one conversation has is that conversation's, if it is its own alone
    either = whole.unionByName(tails)
    alone = either.filter(~F.col("up_shared")).withColumn(
        "parent_conv_id", F.when(depth > 0, F.col("conv"))
    )
    parents = shared.select(
        *[F.col(a).alias(b) for a, b in zip(NODE, PARENT, strict=True)],
        F.col("conv").alias("parent_conv_id"),
        F.col("n_children").alias("_n"),
    )
    below = sketch.attach(either.filter("up_shared"), parents, PARENT, "_n", "inner", hot_rows)
    result = alone.unionByName(below.select(*alone.columns))
    return result.select(
        F.col("conv").alias("conv_id"), depth.cast("long").alias("depth"), "parent_conv_id", *COUNTS, "ends_sha256"
    )


def prefix_trie(
    turns: DataFrame,
    rebuild: bool = False,
    rows_per_block: int = scan.ROWS_PER_BLOCK,
    pages_mb: int = sketch.PAGES_MB,
    hot_rows: int = sketch.HOT_ROWS,
) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv_id, turn, role, text).

    A node is a distinct sequence of first turns; depth 0 is the root. ``conv_id`` is its smallest
    member, so (conv_id, depth) names it. ``n_leaves`` and ``saved_tokens`` (bytes of last texts that
    all members but one need not have) cover its subtree, the node included. ``ends_sha256``
    is the digest of the ids of those members that end there.

    Turns are ordered by ``turn``, NULL first; those of one number by the digest of role and text.
    NULL roles and texts are empty. Rows without conv_id belong to no conversation and are left out;
    repeated rows are further turns. An empty table has no nodes. Further columns are not read.
    ``rebuild`` puts the first turns of one conversation of each group of five before the others
    (``_rebuilt``); a conversation may then be left without turns and ends at the root.
    ``pages_mb`` bounds the sketch; with more prefixes than it suits, more are shuffled.
    """
    scratch = Scratch(turns.sparkSession, "trie")
    numbered = _numbered(turns, scratch, rows_per_block)
    rows, convs = (_rebuilt if rebuild else _plain)(numbered, scratch, hot_rows)
    return _nodes(rows, convs, scratch, rows_per_block, pages_mb, hot_rows)

"""The trie of conversations that share first turns, by van Emde Boas recursion on its depth.

Sequences of turns are cut at half the depth of their block. Sequences with one upper half are one in the upper
trie; a whole upper half is a cut prefix, whose name is the root of a lower trie over the second halves. Upper
trie and lower forest, each half as deep, are cut alike in the same job, so that a trie of depth D takes
log2(D) rounds and not D. After the last round each block is one turn, and each sequence a node.

Totals of subtrees go back the other way: each lower trie's total is grafted onto its cut prefix, and the grafts
are dealt down through the upper tries, along the same cuts, to all nodes above.

A prefix is named by 120 bits: the exclusive or of a hash of each turn and its place, so that a name doesn't
depend on where the prefix was cut. Every step is a grouping with partial sums or a join of unique keys,
but for parents with very many children, of which there are few: these are broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revaudit.operators.scratch import settle

SHARED_TURNS = 6
FAMILY = 100

#: Parents with more than this part of all nodes as children are broadcast; there are fewer of them than this.
FREQUENT_PARTS = 2000
#: Decimal ids that are joined to one piece before a node's digest is taken.
PIECE_IDS = 50_000

_BITS = 60
#: Letters of role and text that order the turns of one number; beyond these their hash does.
_LETTERS = 64


def _hash_bits(*parts: Column) -> tuple[Column, Column]:
    """Two numbers of 60 bits out of the SHA-256 of the parts, each preceded by its length."""
    sized = [x for p in parts for x in (F.char_length(p).cast("string"), F.lit(":"), p)]
    digest = F.sha2(F.concat(*sized).cast("binary"), 256)
    half = _BITS // 4
    return tuple(F.conv(F.substring(digest, 1 + half * i, half), 16, 10).cast("long") for i in (0, 1))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (1, 2, ...), x, y (a hash of role and text), chars: the turns of each conversation in order.

    Turns are in order of turn, null first, then of the first letters of role and text, then of the hash. Rows are
    ranked by ranges of all of that, so a conversation of any length spreads over tasks; what a task needs of
    others is one row per conversation and task. Texts are not shuffled.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    x, y = _hash_bits(role, text)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.substring(role, 1, _LETTERS).alias("role"), F.substring(text, 1, _LETTERS).alias("text"),
        x.alias("x"), y.alias("y"), F.char_length(text).cast("long").alias("chars"), F.rand(7).alias("split"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), *map(F.col, ("role", "text", "x", "y"))]
    # the random number splits rows that are equal in all else
    ranked = rows.repartitionByRange(*order, F.col("split")).sortWithinPartitions(*order).select("conv_id", "x", "y", "chars")
    ranked = settle(ranked.withColumn("rank", F.monotonically_increasing_id()), "trie-turns")
    task = F.shiftright("rank", 33).alias("task")
    begun = ranked.groupBy("conv_id", task).agg(F.min("rank").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begun = begun.select("conv_id", "task", (F.sum("n").over(before) - F.col("n") - F.col("first") + 1).alias("shift"))
    return ranked.withColumn("task", task).join(begun, ["conv_id", "task"]).select(
        "conv_id", (F.col("rank") + F.col("shift")).alias("pos"), "x", "y", "chars"
    )


def rebuilt_turns(turns: DataFrame, shared: int = SHARED_TURNS, family: int = FAMILY) -> tuple[DataFrame, DataFrame]:
    """The turns of the rebuilt conversations, and all conversations (conv_id).

    A conversation c takes the first h turns of c - c % family, h being crc32 of its decimal id modulo `shared`,
    and goes on with its own turns behind its first h. At most `family` conversations share one head.
    """
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared
    convs = convs.select("conv_id", "n", head.alias("head"), (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    sizes = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = settle(convs.join(sizes, "base", "left").withColumn("taken", F.least("head", F.coalesce("base_n", F.lit(0)))), "trie-heads")
    heads = turns.where(F.col("pos") < shared).withColumnRenamed("conv_id", "base")
    heads = heads.join(convs.where("taken > 0").select("base", "conv_id", "taken"), "base").where("pos <= taken")
    longer = convs.where("n > head").select("conv_id", "head", "taken")
    own = turns.join(longer, "conv_id").where("pos > head").withColumn("pos", F.col("pos") - F.col("head") + F.col("taken"))
    columns = ["conv_id", "pos", "x", "y", "chars"]
    return heads.select(columns).unionByName(own.select(columns)), convs.select("conv_id")


def _blocks(turns: DataFrame, levels: int) -> list[DataFrame]:
    """For each level k the blocks of 2^k turns: conv_id, block, x, y and the right half's rx, ry, null without one."""
    nothing = F.lit(None).cast("long")
    out = [turns.select("conv_id", (F.col("pos") - 1).alias("block"), "x", "y", nothing.alias("rx"), nothing.alias("ry"))]
    for k in range(1, levels + 1):
        right = F.col("block") % 2 == 1
        halves = out[-1].groupBy("conv_id", F.shiftright("block", 1).alias("block")).agg(
            F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"),
            F.max(F.when(right, F.col("x"))).alias("rx"), F.max(F.when(right, F.col("y"))).alias("ry"),
        )
        out.append(settle(halves, f"trie-blocks-{k}"))
    return out


def _xor(a: str, b: str) -> Column:
    return F.col(a).bitwiseXOR(F.col(b))


def _down(whole: DataFrame, blocks: list[DataFrame]) -> tuple[DataFrame, list[DataFrame]]:
    """The nodes, and for each level from the deepest the cuts.

    Sequences are (px, py, block, conv_id, n): the name of the root, the block, the lowest conversation and
    how many there are. A cut has the names of the sequence's end (x, y), of its upper half's end (cx, cy) and
    of its root, and whether it goes on behind the cut.
    """
    sequences, cuts = whole, []
    for k in range(len(blocks) - 1, 0, -1):
        cut = sequences.join(blocks[k], ["conv_id", "block"]).select(
            "conv_id", "block", "n", "px", "py",
            _xor("px", "x").alias("x"), _xor("py", "y").alias("y"),
            _xor("px", "x").bitwiseXOR(F.coalesce("rx", F.lit(0).cast("long"))).alias("cx"),
            _xor("py", "y").bitwiseXOR(F.coalesce("ry", F.lit(0).cast("long"))).alias("cy"),
            F.col("rx").isNotNull().alias("deeper"),
        )
        cut = settle(cut, f"trie-cuts-{k}")
        cuts.append(cut)
        upper = cut.groupBy("px", "py", "block", "cx", "cy").agg(F.min("conv_id").alias("conv_id"), F.sum("n").alias("n"))
        upper = upper.select("px", "py", (F.col("block") * 2).alias("block"), "conv_id", "n")
        lower = cut.where("deeper").select(
            F.col("cx").alias("px"), F.col("cy").alias("py"), (F.col("block") * 2 + 1).alias("block"), "conv_id", "n"
        )
        sequences = settle(upper.unionByName(lower), f"trie-halves-{k}")
    return sequences, cuts


def _totals(nodes: DataFrame, cuts: list[DataFrame]) -> DataFrame:
    """x, y, leaves, saved: for every node with others below, the sums over these.

    `nodes` has x, y, px, py, leaf and own; cuts are in order of level, the deepest first.
    """
    sums = [F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]
    below = nodes.groupBy("px", "py").agg(F.sum("leaf").alias("leaves"), F.sum("own").alias("saved"))
    below = settle(below, "trie-totals")
    grafts = []
    for k, cut in enumerate(reversed(cuts)):
        # each lower trie hangs on one cut prefix of this level
        hung = cut.where("deeper").groupBy("cx", "cy").agg(F.first("px").alias("ux"), F.first("py").alias("uy"))
        tied = below.withColumnRenamed("px", "cx").withColumnRenamed("py", "cy").join(hung, ["cx", "cy"], "left")
        tied = settle(tied, f"trie-grafts-{k + 1}")
        grafts.append(tied.where("ux is not null").select(F.col("cx").alias("x"), F.col("cy").alias("y"), "leaves", "saved"))
        root = [F.coalesce("ux", "cx").alias("px"), F.coalesce("uy", "cy").alias("py")]
        below = settle(tied.select(*root, "leaves", "saved").groupBy("px", "py").agg(*sums), f"trie-totals-{k + 1}")
    top = below.select(F.col("px").alias("x"), F.col("py").alias("y"), "leaves", "saved")
    dealt = None
    for k, (cut, graft) in enumerate(zip(cuts, reversed(grafts), strict=True)):
        parts = graft
        if dealt is not None:
            ends = cut.select("x", "y", "cx", "cy", "deeper").join(dealt, ["x", "y"])
            upper = ends.select(F.col("cx").alias("x"), F.col("cy").alias("y"), "leaves", "saved")
            parts = parts.unionByName(upper).unionByName(ends.where("deeper").select("x", "y", "leaves", "saved"))
        dealt = settle(parts.groupBy("x", "y").agg(*sums), f"trie-dealt-{k}")
    return top if dealt is None else dealt.unionByName(top)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join runs of ids of one node to pieces; rows come in order of node and id."""
    key, ids, first = None, [], None

    def piece():
        rows = [[key[0]], [key[1]], [first], [",".join(map(str, ids))]]
        return pa.RecordBatch.from_arrays([*(pa.array(r, pa.int64()) for r in rows[:3]), pa.array(rows[3])], ["x", "y", "first", "ids"])

    made: list[pa.RecordBatch] = []
    for batch in batches:
        for x, y, conv in zip(*(batch.column(c).to_pylist() for c in ("x", "y", "conv_id")), strict=True):
            if key != (x, y) or len(ids) >= PIECE_IDS:
                if ids:
                    made.append(piece())
                key, ids, first = (x, y), [], conv
            ids.append(conv)
        if made:
            yield pa.Table.from_batches(made).combine_chunks().to_batches()[0]
            made = []
    if ids:
        yield piece()


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's pieces, which come in order."""
    key, digest = None, None
    out: list[tuple[int, int, str]] = []

    def rows():
        columns = list(zip(*out, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2])], ["x", "y", "ends_sha256"]
        )

    for batch in batches:
        for x, y, ids in zip(*(batch.column(c).to_pylist() for c in ("x", "y", "ids")), strict=True):
            if key != (x, y):
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = (x, y), hashlib.sha256(ids.encode())
            else:
                digest.update(("," + ids).encode())
        if out:
            yield rows()
            out.clear()
    if key is not None:
        out.append((*key, digest.hexdigest()))
        yield rows()


def end_digests(ends: DataFrame) -> DataFrame:
    """x, y, ends_sha256 of the ids of the conversations that end at each node, ascending, joined by commas.

    `ends` has x, y and conv_id. Ids are joined to pieces task by task, so that a node where very many conversations end
    sends pieces on and not rows; SHA-256 then reads a node's pieces one after the other and holds none.
    """
    order = ["x", "y", "conv_id"]
    pieces = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _pieces, "x long, y long, first long, ids string"
    )
    dealt = pieces.repartition("x", "y").sortWithinPartitions("x", "y", "first")
    return dealt.select("x", "y", "ids").mapInArrow(_hash_pieces, "x long, y long, ends_sha256 string")


def _with_parents(nodes: DataFrame, families: DataFrame) -> DataFrame:
    """The nodes with their parent's conv_id. `families` has conv_id, x, y and n_children of each parent."""
    total = nodes.count()
    many = F.col("n_children") * FREQUENT_PARTS > total
    parents = families.select(F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    frequent = F.broadcast(parents.where(many).drop("n_children"))
    few = nodes.join(frequent.select("px", "py"), ["px", "py"], "left_anti").join(parents.where(~many).drop("n_children"), ["px", "py"])
    return nodes.join(frequent, ["px", "py"]).unionByName(few)


def trie(conversations: DataFrame, shared: int = SHARED_TURNS, family: int = FAMILY) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    `conversations` has conv_id, turn, role and text; other columns are not read. Null roles and texts
    are empty; rows without conv_id belong to no conversation and are left out. Turns of one number are in order of the
    first 64 letters of role, then of text, then of their hash, and repeated rows are turns of their own. (conv_id, depth) names a node. Without conversations there is no node.
    """
    turns = settle(numbered_turns(conversations), "trie-numbered")
    turns, convs = rebuilt_turns(turns, shared, family)
    place = F.col("pos").cast("string")
    x, y = _hash_bits(F.col("x").cast("string"), F.col("y").cast("string"), place)
    turns = settle(turns.select("conv_id", "pos", x.alias("x"), y.alias("y"), "chars"), "trie-rebuilt")
    zero = F.lit(0).cast("long")
    whole = turns.groupBy("conv_id").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.max("pos").alias("depth"))
    whole = convs.join(whole, "conv_id", "left").select(
        "conv_id", F.coalesce("x", zero).alias("x"), F.coalesce("y", zero).alias("y"), F.coalesce("depth", zero).alias("depth")
    )
    whole = settle(whole, "trie-whole")
    groups = whole.groupBy("x", "y", "depth").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"))
    groups = settle(groups, "trie-sequences")
    top = groups.agg(F.min("conv_id").alias("conv_id"), F.sum("n").alias("n"), F.max("depth").alias("deepest")).first()
    levels = max((top["deepest"] or 0) - 1, 0).bit_length()

    # only the lowest of equal conversations goes on
    sequences = groups.where("depth > 0").select(zero.alias("px"), zero.alias("py"), zero.alias("block"), "conv_id", "n")
    distinct = settle(turns.join(sequences.select("conv_id"), "conv_id", "left_semi"), "trie-distinct")
    ended, cuts = _down(sequences, _blocks(distinct, levels))
    last = distinct.select("conv_id", (F.col("pos") - 1).alias("block"), "x", "y", "chars")
    nodes = ended.join(last, ["conv_id", "block"]).select(
        "conv_id", (F.col("block") + 1).alias("depth"), F.col("n").alias("n_convs"), "px", "py",
        _xor("px", "x").alias("x"), _xor("py", "y").alias("y"), ((F.col("n") - 1) * F.col("chars")).alias("own"),
    )
    children = nodes.groupBy("px", "py").agg(F.count("*").alias("n_children"))
    children = children.select(F.col("px").alias("x"), F.col("py").alias("y"), "n_children")
    leaf = F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long")
    nodes = nodes.join(children, ["x", "y"], "left").withColumn("leaf", leaf)
    nodes = settle(nodes, "trie-nodes")

    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select("conv_id", zero.alias("depth"), "n_convs", zero.alias("x"), zero.alias("y"), zero.alias("own"))
    root = root.join(children, ["x", "y"], "left").withColumn("leaf", leaf)
    families = nodes.select("conv_id", "x", "y", "n_children").unionByName(root.select("conv_id", "x", "y", "n_children"))
    linked = _with_parents(nodes, families.where("n_children > 0")).drop("px", "py")
    everything = linked.unionByName(root.withColumn("parent_conv_id", F.lit(None).cast("long")).select(*linked.columns))
    ends = settle(end_digests(whole.select("x", "y", "conv_id")), "trie-ends")
    return (
        everything.join(settle(_totals(nodes, cuts), "trie-sums"), ["x", "y"], "left")
        .join(ends, ["x", "y"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs",
            F.coalesce("n_children", zero).alias("n_children"),
            (F.col("leaf") + F.coalesce("leaves", zero)).alias("n_leaves"),
            (F.col("own") + F.coalesce("saved", zero)).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
    )

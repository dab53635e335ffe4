"""Prefix trie of conversations by Spark SQL ROLLUP (operator 11).

The turns of a conversation become columns: position 1 to WIDTH in the first column block,
the next WIDTH in the next block, and so on. A block row is keyed by the node that the blocks
before it end at, so one ``GROUP BY block, node, ROLLUP(turn_1, ..., turn_W)`` over the block
rows of all conversations gives every prefix of every conversation once: ``grouping_id`` says
how many turns of the block a group has, and a group that has more positions than turns is
dropped before the aggregation. A turn is its 128-bit hash of role and text; a node is the
exclusive or of the hashes of (position, turn) on its path, which is a prefix aggregate and so
known for every block without walking a conversation.

Sums over subtrees come from the same ROLLUP, not from walking the trie. A node belongs to
its smallest member; the nodes of one conversation that belong to it are the deepest ones on
its path. So each conversation has one number, ``shared``: the tokens of those of its turns
whose nodes belong to others. What a subtree saves is the sum, over its members but the
smallest, of ``shared`` less the tokens above the subtree; its leaves are counted at their
smallest members. Both are sums over members. Two ROLLUPs, then: one to find the owners, one
for the sums.

Skew: every aggregate has a fixed-width buffer and map-side partial aggregation, so an opening
shared by a third of all conversations costs one row per task. Turns are numbered within
(conversation, range of turn numbers), so one very long conversation spreads too. The members
that end at a node are gathered in chunks of at most 8,192 ids; only the SHA-256 over the ids
of a node with several chunks runs through them one after another, in order, in constant
memory: that hash is sequential by definition.

Defined cases: a null role or text is empty; a null turn comes first; turns with the same number
are ordered by role, then by the hash of the text, and equal rows are turns of their own; rows without conv_id are
ignored; an empty table has no node, not even a root; columns beyond the four are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assetlens.operators.prefix import before_ranges, levels_for
from assetlens.session import materialize

WIDTH = 8
"""Turns in a column block."""
TURN_BITS = 12
"""Turn numbers that share all but these low bits are numbered by one window."""
SUPER_BLOCK = 512
"""Blocks of one conversation whose prefixes one window finds."""
CHUNK_BITS = 13
"""Ids that share all but these low bits are in one chunk of a node's ending members."""

_long = lambda n: F.lit(n).cast("bigint")
_NO_TURN = -(1 << 60)  # the range of turns without a number, below all others


def numbered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), h1, h2 (hash of role and text), tokens (code points of the text);
    a written table."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.col("turn").cast("bigint")
    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("turn"), role.alias("role"),
                        F.xxhash64(_long(1), role, text).alias("h1"), F.xxhash64(_long(2), role, text).alias("h2"),
                        F.length(text).cast("bigint").alias("tokens"),
                        F.coalesce(F.shiftright(turn, TURN_BITS), _long(_NO_TURN)).alias("part")) \
        .where(F.col("conv_id").isNotNull())
    inside = Window.partitionBy("conv_id", "part").orderBy("turn", "role", "h1", "h2")
    rows = materialize(rows.select("conv_id", "part", "h1", "h2", "tokens", F.row_number().over(inside).cast("bigint").alias("n")),
                       "trie-turns")
    # One row per conversation and 4,096 turn numbers: this window stays small.
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = (rows.groupBy("conv_id", "part").agg(F.max("n").alias("n"))
              .select("conv_id", "part", F.coalesce(F.sum("n").over(earlier), _long(0)).alias("before")))
    numbered = rows.join(before, ["conv_id", "part"])
    return materialize(numbered.select("conv_id", (F.col("before") + F.col("n")).alias("pos"), "h1", "h2", "tokens"),
                       "trie-numbered")


def with_shared_openings(numbered: DataFrame, family: int = 100, most: int = 5) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on their family's opening: the first h turns (h: crc32 of the id as
    text, modulo ``most + 1``) come from the conversation ``c - c % family``, and its own
    turns after its first h follow. Gives the rebuilt turns and the ids of all conversations,
    those without turns included."""
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string").cast("binary")) % (most + 1)).cast("bigint")
    head = (c - c % family).alias("head")
    openings = numbered.where((c % family == 0) & (F.col("pos") <= most)) \
        .select(c.alias("head"), "pos", "h1", "h2", "tokens")
    lengths = openings.groupBy("head").agg(F.count(F.lit(1)).alias("length"))
    ids = numbered.select("conv_id").distinct()
    taken = (ids.select("conv_id", head, h.alias("h")).join(openings, "head").where(F.col("pos") <= F.col("h"))
             .select("conv_id", "pos", "h1", "h2", "tokens"))
    own = (numbered.where(F.col("pos") > h).withColumn("head", c - c % family).join(lengths, "head", "left")
           .select("conv_id", (F.col("pos") - h + F.least(h, F.coalesce("length", _long(0)))).alias("pos"),
                   "h1", "h2", "tokens"))
    return taken.unionByName(own), ids


def _step(seed: int, pos: Column, h1: Column, h2: Column) -> Column:
    """What a turn at a position adds (exclusive or) to the hash of its node."""
    return F.xxhash64(_long(seed), pos.cast("bigint"), h1, h2)


def column_blocks(numbered: DataFrame, conv_ids: DataFrame) -> DataFrame:
    """One row per conversation and WIDTH turns (a conversation without turns has one): conv_id,
    block, p1, p2, base (node before the block, tokens up to it), h1_j, h2_j, c_j (turns), length, total (turns and tokens
    of the conversation), e1, e2 (the node that it ends at); a written table."""
    pos, nothing = F.col("pos"), F.lit(None).cast("bigint")
    rows = numbered.select("conv_id", "pos", "h1", "h2", "tokens",
                           *[_step(s, pos, F.col("h1"), F.col("h2")).alias(f"x{s}") for s in (1, 2)])
    rows = rows.unionByName(conv_ids.select("conv_id", *[nothing.alias(c) for c in rows.columns[1:]]))
    block = F.coalesce(F.floor((pos - 1) / WIDTH), _long(0)).cast("bigint")
    at = [(pos - 1) % WIDTH == j for j in range(WIDTH)]
    blocks = rows.groupBy("conv_id", block.alias("block")).agg(
        *[F.max(F.when(at[j], F.col(c))).alias(f"{name}_{j + 1}") for j in range(WIDTH)
          for name, c in (("h1", "h1"), ("h2", "h2"), ("c", "tokens"))],
        F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"),
        F.count("pos").alias("n"), F.coalesce(F.sum("tokens"), _long(0)).alias("sum"))
    blocks = materialize(blocks.withColumn("part", F.floor(F.col("block") / SUPER_BLOCK).cast("bigint")), "trie-turn-blocks")
    merge = {"x1": F.bit_xor, "x2": F.bit_xor, "n": F.sum, "sum": F.sum}
    zero = lambda c: F.coalesce(c, _long(0))
    parts = materialize(blocks.groupBy("conv_id", "part").agg(*[zero(f(F.col(c))).alias(c) for c, f in merge.items()]),
                        "trie-parts")
    deepest = parts.agg(F.max("part")).first()[0] or 0
    before = before_ranges(parts, ["conv_id"], "part", merge, levels_for(deepest + 1))
    before = before.select("conv_id", "part", *[F.col(c).alias(f"before_{c}") for c in merge])
    whole = parts.groupBy("conv_id").agg(F.bit_xor("x1").alias("e1"), F.bit_xor("x2").alias("e2"),
                                         F.sum("n").alias("length"), F.sum("sum").alias("total"))
    earlier = Window.partitionBy("conv_id", "part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    prior = {name: zero(merge[c](F.col(c)).over(earlier)) for name, c in (("p1", "x1"), ("p2", "x2"), ("base", "sum"))}
    local = blocks.withColumns(prior)
    out = local.join(before, ["conv_id", "part"], "left").join(whole, "conv_id")
    return materialize(out.select(
        "conv_id", "block", F.col("p1").bitwiseXOR(zero(F.col("before_x1"))).alias("p1"),
        F.col("p2").bitwiseXOR(zero(F.col("before_x2"))).alias("p2"),
        (F.col("base") + zero(F.col("before_sum"))).alias("base"),
        *[f"{c}_{j + 1}" for j in range(WIDTH) for c in ("h1", "h2", "c")], "length", "total", "e1", "e2"), "trie-blocks")


def _rollup(blocks: DataFrame, aggregates: str) -> DataFrame:
    """All prefixes in one ROLLUP, with the ``aggregates`` over the members of each: n1, n2 (node),
    pa1, pa2 (parent; null for the root), depth, above (tokens above the node's turn)."""
    turns = ", ".join(f"(h1_{j}, h2_{j}, c_{j})" for j in range(1, WIDTH + 1))
    present = " + ".join(f"if(h1_{j} IS NULL, 0, 1)" for j in range(1, WIDTH + 1))
    columns = ", ".join(f"h1_{j}, h2_{j}, c_{j}" for j in range(1, WIDTH + 1))
    # Three grouping columns a turn: their bits of grouping_id are set where the turn is rolled up.
    groups = blocks.sparkSession.sql(
        f"SELECT block, p1, p2, base, {columns}, {WIDTH} - bit_count(grouping_id()) DIV 3 AS turns, {aggregates} "
        f"FROM {{blocks}} GROUP BY block, p1, p2, base, ROLLUP({turns}) "
        f"HAVING {WIDTH} - bit_count(grouping_id()) DIV 3 = {present} "
        f"AND (block = 0 OR {WIDTH} - bit_count(grouping_id()) DIV 3 > 0)", blocks=blocks)
    depth = F.col("block") * WIDTH + F.col("turns")
    last = {seed: _long(0) for seed in (1, 2)}
    node = {seed: F.col(f"p{seed}") for seed in (1, 2)}
    tokens = F.col("base")
    for j in range(1, WIDTH + 1):
        pos, here = F.col("block") * WIDTH + j, F.col("turns") >= j
        for seed in (1, 2):
            step = _step(seed, pos, F.col(f"h1_{j}"), F.col(f"h2_{j}"))
            node[seed] = node[seed].bitwiseXOR(F.when(here, step).otherwise(_long(0)))
            last[seed] = F.when(F.col("turns") == j, step).otherwise(last[seed])
        tokens = tokens + F.when(F.col("turns") > j, F.col(f"c_{j}")).otherwise(_long(0))
    rest = [c for c in groups.columns if c not in {"block", "p1", "p2", "base", "turns", *columns.split(", ")}]
    nodes = groups.select(*rest, depth.cast("bigint").alias("depth"), tokens.alias("above"),
                          *[node[s].alias(f"n{s}") for s in (1, 2)], *[last[s].alias(f"l{s}") for s in (1, 2)])
    parent = [F.when(F.col("depth") > 0, F.col(f"n{s}").bitwiseXOR(F.col(f"l{s}"))).alias(f"pa{s}") for s in (1, 2)]
    return nodes.select("*", *parent).drop("l1", "l2")


def nodes_of(blocks: DataFrame) -> DataFrame:
    """All trie nodes of the conversations in ``blocks``: n1, n2 (node), pa1, pa2 (parent, null
    for the root), conv_id (smallest member), parent_conv_id, depth, n_convs, n_children,
    n_leaves, saved_tokens."""
    first = _rollup(blocks, "min(conv_id) AS owner, max(length) AS longest")
    owned = first.groupBy(F.col("owner").alias("conv_id")).agg(
        F.min("above").alias("owned_above"), F.max((F.col("longest") == F.col("depth")).cast("bigint")).alias("leaf"))
    members = blocks.join(owned, "conv_id", "left") \
        .withColumns({"shared": F.coalesce("owned_above", "total"), "leaf": F.coalesce("leaf", _long(0))})
    nodes = _rollup(members, "min(conv_id) AS conv_id, count(1) AS n_convs, min_by(shared, conv_id) AS own_shared, "
                             "sum(shared) AS sum_shared, sum(leaf) AS n_leaves")
    saved = F.col("sum_shared") - F.col("own_shared") - (F.col("n_convs") - 1) * F.col("above")
    nodes = materialize(nodes.select("n1", "n2", "pa1", "pa2", "conv_id", "depth", "n_convs", "n_leaves",
                                     saved.alias("saved_tokens")), "trie-nodes")
    children = nodes.where("depth > 0").groupBy(F.col("pa1").alias("n1"), F.col("pa2").alias("n2")) \
        .agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(F.col("n1").alias("pa1"), F.col("n2").alias("pa2"), F.col("conv_id").alias("parent_conv_id"))
    return (nodes.join(parents, ["pa1", "pa2"], "left").join(children, ["n1", "n2"], "left")
            .withColumn("n_children", F.coalesce("n_children", _long(0))))


def ending_chunks(blocks: DataFrame) -> DataFrame:
    """The conversations that end at each node, in chunks of ids: n1, n2, chunk (ascending with
    the ids), ids (ascending); a written table."""
    ends = blocks.where("block = 0").select(F.col("e1").alias("n1"), F.col("e2").alias("n2"), "conv_id")
    chunk = F.shiftright("conv_id", CHUNK_BITS).alias("chunk")
    return materialize(ends.groupBy("n1", "n2", chunk).agg(F.sort_array(F.collect_list("conv_id")).alias("ids")),
                       "trie-ends")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the texts of consecutive rows with the same node, comma between them."""
    node, digest = None, None
    schema = pa.schema([("n1", pa.int64()), ("n2", pa.int64()), ("ends_sha256", pa.string())])

    def done() -> Iterator[pa.RecordBatch]:
        if node is not None:
            yield pa.RecordBatch.from_pylist([{"n1": node[0], "n2": node[1], "ends_sha256": digest.hexdigest()}], schema)

    for batch in batches:
        for n1, n2, text in zip(*(batch.column(c).to_pylist() for c in ("n1", "n2", "text"))):
            if node == (n1, n2):
                digest.update(b"," + text.encode())
            else:
                yield from done()
                node, digest = (n1, n2), hashlib.sha256(text.encode())
    yield from done()


def ends_digest(chunks: DataFrame) -> DataFrame:
    """n1, n2, ends_sha256: of the ending members' ids as decimal text, ascending, comma-joined."""
    text = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")
    several = chunks.groupBy("n1", "n2").count().where("count > 1").select("n1", "n2")
    one = chunks.join(several, ["n1", "n2"], "left_anti").select("n1", "n2", F.sha2(text, 256).alias("ends_sha256"))
    # Few nodes have several chunks; their rows go by node, in order, through one hash each.
    ordered = (chunks.join(several, ["n1", "n2"], "left_semi").repartition("n1", "n2")
               .sortWithinPartitions("n1", "n2", "chunk").select("n1", "n2", text.alias("text")))
    return one.unionByName(ordered.mapInArrow(_digests, "n1 long, n2 long, ends_sha256 string"))


def prefix_trie(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Trie of the conversations ``turns`` (conv_id, turn, role, text) as they are: the nodes
    (``nodes_of``) and the members that end at each (``ending_chunks``). The last turn of a node
    is turn number ``depth`` of conversation ``conv_id``."""
    numbered = numbered_turns(turns)
    blocks = column_blocks(numbered, numbered.select("conv_id").distinct())
    return nodes_of(blocks), ending_chunks(blocks)


def shared_opening_trie(turns: DataFrame) -> DataFrame:
    """Trie of the conversations rebuilt on their families' openings (``with_shared_openings``):
    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    numbered, ids = with_shared_openings(numbered_turns(turns))
    blocks = column_blocks(numbered, ids)
    digests = ends_digest(ending_chunks(blocks))
    nodes = nodes_of(blocks).join(digests, ["n1", "n2"], "left")
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))

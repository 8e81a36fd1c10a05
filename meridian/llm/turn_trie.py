"""Prefix trie of conversations: Spark SQL ROLLUP over positional turn-id columns.

A turn's id is the MD5 of its role and text. A conversation becomes rows of ``WIDTH`` positional turn-id
columns, one row per block of its turns; a row also carries the key of the node that its block hangs
from (``pa``, ``pb``: two 64-bit lanes, the XOR of position-and-turn hashes over all earlier turns).
``GROUP BY block, pa, pb, ROLLUP (t1 .. t8)`` then aggregates all prefixes of all conversations
together; ``grouping_id`` tells the depth. Levels past a row's last turn are filtered below the
aggregation. A second ROLLUP adds up what lies below each node: a node's value is put on its smallest member,
whose nodes are the last part of its own path, so suffix sums along each conversation, summed over a
node's members, count every node of the subtree once. There is no loop over depths.

Conversations of any length are handled in bounded groups: places in a conversation come from a
range-dealt sort (a local number plus the rows of the earlier ranges), and running values over the blocks
are taken in chapters of ``CHAPTER`` turns whose totals are added by a second, far smaller window.
Parents with over 1/1000 of all nodes as children (at most 1,000 of them) are joined by broadcast, the rest by
shuffle. Ids that end at a node are put together in chunks of bounded length, sorted by range, and
hashed as a stream.

Defined results: null role or text is empty; null turns come first and turns with one number are ordered
by the turn id; rows repeated whole are turns of their own; rows without conv_id belong to no conversation
and are left out; a conversation without turns is a member of the root; other columns are ignored, so clashing
names are harmless; an empty table has no nodes.
"""

from __future__ import annotations

import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.llm.common import shuffle_partitions, written

WIDTH = 8
#: Turns whose running values are taken in one window.
CHAPTER = 8192
#: Nodes with more than this share of all nodes as children are broadcast (at most 1 / HOT_SHARE of them).
HOT_SHARE = 0.001
#: Conversation ids put together in one chunk of a node's list.
CHUNK = 4096
#: Turns of the base conversation that may head a rebuilt one, and how far ids reach to their base.
HEADS, FAMILY = 6, 100


def turns_of(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """(conv_id, pos, tid, chars): the turns of every conversation in order, places from 1."""
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = (df.filter(F.col(conv_col).isNotNull())
           .select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
                   F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))).alias("tid"),
                   F.char_length(text).cast("long").alias("chars"), F.monotonically_increasing_id().alias("row")))
    n = max(1, shuffle_partitions(df.sparkSession))
    dealt = written(src.repartitionByRange(n, "conv_id", F.col("turn").asc_nulls_first(), "tid", "row")
                    .withColumn("part", F.spark_partition_id()), "turns")
    counts = dealt.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    crossing = (counts.withColumns({"before": before}).filter("before > 0")     # at most one conversation per range border
                .select(F.col("conv_id").alias("c"), F.col("part").alias("p"), "before"))
    local = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_first(), "tid", "row"))
    return (dealt.withColumn("local", local)
            .join(F.broadcast(crossing), (F.col("conv_id") == F.col("c")) & (F.col("part") == F.col("p")), "left")
            .select("conv_id", (F.col("local") + F.coalesce("before", F.lit(0))).alias("pos"), "tid", "chars"))


def head_turns(conv_id: Column) -> Column:
    """How many turns of its base head the rebuilt conversation."""
    return F.pmod(F.crc32(F.encode(conv_id.cast("string"), "UTF-8")), F.lit(HEADS))


def rebuild(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, tid, chars) of the rebuilt conversations; one without turns has a row with null pos.

    Conversation c is the first h turns of conversation c - c % FAMILY (none if absent), then its own
    after its first h. A base heads at most 2 * FAMILY conversations, so the join is bounded.
    """
    heads = turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < HEADS))
    bases = heads.groupBy("conv_id").agg(F.collect_list(F.struct("pos", "tid", "chars")).alias("head"))    # under HEADS entries
    convs = (turns.groupBy("conv_id").agg(F.max("pos").alias("own"))
             .withColumns({"h": head_turns(F.col("conv_id")), "base": F.col("conv_id") - F.col("conv_id") % FAMILY}))
    joined = convs.join(bases.withColumnRenamed("conv_id", "b"), F.col("base") == F.col("b"), "left")
    kept = F.filter(F.coalesce("head", F.array().cast(bases.schema["head"].dataType)), lambda x: x["pos"] <= F.col("h"))
    plan = joined.select("conv_id", "h", "own", kept.alias("head"), F.size(kept).cast("long").alias("taken"))
    first = plan.select("conv_id", F.inline("head"))
    # own turns move to follow the head; the shift is null where the head has all h turns
    shift = plan.filter("taken < h").select(F.col("conv_id").alias("c"), (F.col("taken") - F.col("h")).alias("shift"))
    own = turns.filter(F.col("pos") > head_turns(F.col("conv_id")))
    own = (own.join(shift, F.col("conv_id") == F.col("c"), "left")
           .select("conv_id", (F.col("pos") + F.coalesce("shift", F.lit(0))).alias("pos"), "tid", "chars"))
    bare = (plan.filter("taken = 0 and own <= h")
            .select("conv_id", F.lit(None).cast("long").alias("pos"), F.lit(None).cast("binary").alias("tid"), F.lit(None).cast("long").alias("chars")))
    return first.unionByName(own).unionByName(bare)


def _lane(seed: int, pos: Column, tid: Column) -> Column:
    return F.coalesce(F.when(tid.isNotNull(), F.xxhash64(F.lit(seed), pos, tid)), F.lit(0).cast("long"))


def _xor(cols) -> Column:
    out = None
    for c in cols:
        out = c if out is None else out.bitwiseXOR(c)
    return out


def _running(df: DataFrame, values: dict[str, tuple], width: int, *, later: bool) -> DataFrame:
    """Adds, per conversation, each value's aggregate over the earlier (or later) blocks.

    ``values``: new column -> (aggregate, column, neutral value, combination of two). Chapters bound the windows.
    """
    df = df.withColumn("chapter", F.floor(F.col("block") * width / CHAPTER))
    edge = F.desc if later else F.asc
    past = lambda key, by: Window.partitionBy(*key).orderBy(edge(by)).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy("conv_id", "chapter").agg(*[f(c).alias(n) for n, (f, c, _, _) in values.items()])
    w = past(["conv_id"], "chapter")
    totals = (totals.select(F.col("conv_id").alias("c"), F.col("chapter").alias("ch"), F.count("*").over(w).alias("earlier"),
                            *[F.coalesce(f(F.col(n)).over(w), F.lit(z)).alias(f"_{n}") for n, (f, _, z, _) in values.items()])
              .filter("earlier > 0"))                       # only conversations of several chapters
    w = past(["conv_id", "chapter"], "block")
    df = df.withColumns({n: F.coalesce(f(F.col(c)).over(w), F.lit(z)) for n, (f, c, z, _) in values.items()})
    joined = df.join(totals, (F.col("conv_id") == F.col("c")) & (F.col("chapter") == F.col("ch")), "left")
    joined = joined.withColumns({n: both(F.col(n), F.coalesce(f"_{n}", F.lit(z))) for n, (_, _, z, both) in values.items()})
    return joined.drop("chapter", "c", "ch", "earlier", *[f"_{n}" for n in values])


def blocks_of(turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """(conv_id, block, pa, pb, t1.., l1.., size): rows of positional columns, each with its prior node's key."""
    slot = F.pmod(F.col("pos") - 1, F.lit(width)) + 1
    block = F.coalesce(F.floor((F.col("pos") - 1) / width), F.lit(0)).cast("long")
    picked = [F.max(F.when(slot == i, F.col(c))).alias(f"{k}{i}") for k, c in (("t", "tid"), ("l", "chars")) for i in range(1, width + 1)]
    rows = turns.groupBy("conv_id", block.alias("block")).agg(*picked, F.count("pos").alias("size"))
    at = lambda i: F.col("block") * width + i
    rows = rows.withColumns({k: _xor(_lane(s, at(i), F.col(f"t{i}")) for i in range(1, width + 1)) for k, s in (("xa", 11), ("xb", 23))})
    both = lambda x, y: x.bitwiseXOR(y)
    rows = _running(rows, {"pa": (F.bit_xor, "xa", 0, both), "pb": (F.bit_xor, "xb", 0, both)}, width, later=False)
    # the key of the conversation's end, if it ends in this row (a full block may be followed by another)
    return rows.withColumns({"ea": F.col("pa").bitwiseXOR(F.col("xa")), "eb": F.col("pb").bitwiseXOR(F.col("xb"))}).drop("xa", "xb")


def _rollup(blocks: DataFrame, aggregates: str, width: int, name: str) -> DataFrame:
    """One row per trie node: its key (na, nb), depth, last turn and the aggregates over its members."""
    view = f"trie_{name}_{id(blocks)}"
    blocks.createOrReplaceTempView(view)
    ts = [f"t{i}" for i in range(1, width + 1)]
    # grouping_id() has a bit for every rolled-up column: level i keeps t1 .. ti
    real = " OR ".join(f"(grouping_id() = {(1 << (width - i)) - 1} AND t{i} IS NOT NULL)" for i in range(1, width + 1))
    out = blocks.sparkSession.sql(f"""
        SELECT block, pa, pb, {', '.join(ts)}, CAST(grouping_id() AS BIGINT) AS gid, {aggregates}
        FROM {view} GROUP BY block, pa, pb, ROLLUP ({', '.join(ts)})
        HAVING {real} OR (grouping_id() = {(1 << width) - 1} AND block = 0)""")
    blocks.sparkSession.catalog.dropTempView(view)
    level = F.lit(0)
    for i in range(1, width + 1):
        level = F.when(F.col("gid") == (1 << (width - i)) - 1, F.lit(i)).otherwise(level)
    at = lambda i: F.col("block") * width + i
    out = out.withColumns({"level": level, **{k: _xor([F.col(p), *(_lane(s, at(i), F.col(f"t{i}")) for i in range(1, width + 1))])
                                              for k, p, s in (("na", "pa", 11), ("nb", "pb", 23))}})
    last = F.coalesce(*[F.when(F.col("level") == i, F.col(f"t{i}")) for i in range(1, width + 1)])
    return out.withColumns({"depth": F.col("block") * width + F.col("level"), "last": last}).drop(*ts, "gid", "pa", "pb")


def _by_level(prefix: str, width: int) -> Column:
    return F.coalesce(*[F.when(F.col("level") == i, F.col(f"{prefix}{i}")) for i in range(1, width + 1)], F.lit(0).cast("long"))


def _chunks(batches):
    """Rows sorted by (ea, eb, conv_id) -> (ea, eb, first, ids): bounded pieces of each node's id list."""
    def piece(key, ids):
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])],
            ["ea", "eb", "first", "ids"])
    out, key, held = [], None, []
    for b in batches:
        for a, z, c in zip(*(b.column(x).to_pylist() for x in ("ea", "eb", "conv_id"))):
            if held and ((a, z) != key or len(held) >= CHUNK):
                out.append(piece(key, held))
                held = []
            key = (a, z)
            held.append(c)
        if out:
            yield from pa.Table.from_batches(out).combine_chunks().to_batches()
            out = []
    if held:
        yield piece(key, held)


def _hashes(batches):
    """Pieces sorted by (ea, eb, first) -> (ea, eb, ends): the SHA-256 of each node's whole list."""
    key, sha = None, None

    def done():
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([sha.hexdigest()])], ["ea", "eb", "ends"])
    for b in batches:
        out = []
        for a, z, ids in zip(*(b.column(x).to_pylist() for x in ("ea", "eb", "ids"))):
            if (a, z) != key:
                if sha:
                    out.append(done())
                key, sha = (a, z), hashlib.sha256()
                sha.update(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        if out:
            yield from pa.Table.from_batches(out).combine_chunks().to_batches()
    if sha:
        yield done()


def _ends(blocks: DataFrame) -> DataFrame:
    """(ea, eb, ends): SHA-256 of the ascending, comma-joined ids of the conversations that end at a node."""
    last = blocks.groupBy("conv_id").agg(F.max(F.struct("block", "ea", "eb")).alias("e")).select("conv_id", "e.ea", "e.eb")
    n = max(1, shuffle_partitions(blocks.sparkSession))
    pieces = (last.repartitionByRange(n, "ea", "eb", "conv_id").sortWithinPartitions("ea", "eb", "conv_id")
              .mapInArrow(_chunks, "ea long, eb long, first long, ids string"))
    return (pieces.repartition(n, "ea", "eb").sortWithinPartitions("ea", "eb", "first")
            .mapInArrow(_hashes, "ea long, eb long, ends string"))


def trie(turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per node of the prefix trie of ``turns`` (conv_id, pos, tid, chars; null pos: no turns).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    blocks = written(blocks_of(turns, width), "trie-blocks")
    lens = ", ".join(f"max(l{i}) AS l{i}" for i in range(1, width + 1))
    nodes = _rollup(blocks, f"count(*) AS n_convs, min(conv_id) AS conv_id, {lens}", width, "nodes")
    at = F.col("depth")
    nodes = nodes.select(
        "conv_id", "depth", "block", "level", "na", "nb", "n_convs",
        ((F.col("n_convs") - 1) * _by_level("l", width)).alias("value"),
        *[F.when(at > 0, F.col(n).bitwiseXOR(_lane(s, at, F.col("last")))).alias(p) for p, n, s in (("pa", "na", 11), ("pb", "nb", 23))])
    nodes = written(nodes, "trie-nodes")

    children = nodes.filter("depth > 0").groupBy("pa", "pb").agg(F.count("*").alias("n_children"))
    children = written(children.select(F.col("pa").alias("ka"), F.col("pb").alias("kb"), "n_children"), "trie-children")
    key = (F.col("na") == F.col("ka")) & (F.col("nb") == F.col("kb"))
    nodes = written(nodes.join(children, key, "left").drop("ka", "kb").fillna({"n_children": 0}), "trie-counted")

    # what a conversation owns: the nodes of which it is the smallest member, the last part of its path
    own = [F.sum(F.when(F.col("level") == i, F.col("value"))).alias(f"w{i}") for i in range(1, width + 1)]
    owned = (nodes.groupBy(F.col("conv_id").alias("c"), F.col("block").alias("bl"))
             .agg(*own, F.max((F.col("n_children") == 0).cast("long")).alias("leaf")))
    rows = (blocks.select("conv_id", "block", "pa", "pb", *[f"t{i}" for i in range(1, width + 1)])
            .join(owned, (F.col("conv_id") == F.col("c")) & (F.col("block") == F.col("bl")), "left").drop("c", "bl")
            .fillna(0, subset=[f"w{i}" for i in range(1, width + 1)] + ["leaf"]))
    add = lambda x, y: x + y
    rows = rows.withColumn("w", sum((F.col(f"w{i}") for i in range(2, width + 1)), F.col("w1")))
    rows = _running(rows, {"after": (F.sum, "w", 0, add), "leaves": (F.sum, "leaf", 0, add)}, width, later=True)
    below = {f"s{i}": sum((F.col(f"w{j}") for j in range(i, width + 1)), F.col("after")) for i in range(width, 0, -1)}
    rows = rows.select("block", "pa", "pb", *[f"t{i}" for i in range(1, width + 1)], (F.col("leaves") + F.col("leaf")).alias("leaves"),
                       *[c.alias(n) for n, c in below.items()])
    sums = ", ".join(f"sum(s{i}) AS s{i}" for i in range(1, width + 1))
    # the root has no text, so what lies below it is what lies below its first level
    under = _rollup(rows, f"sum(leaves) AS n_leaves, {sums}", width, "sums")
    saved = F.when(F.col("level") == 0, F.col("s1")).otherwise(_by_level("s", width))
    under = under.select(F.col("na").alias("ua"), F.col("nb").alias("ub"), "n_leaves", saved.alias("saved_tokens"))
    out = nodes.join(under, (F.col("na") == F.col("ua")) & (F.col("nb") == F.col("ub")))

    ends = _ends(blocks)
    out = out.join(ends, (F.col("na") == F.col("ea")) & (F.col("nb") == F.col("eb")), "left")
    out = written(out.select("conv_id", "depth", "pa", "pb", "na", "nb", "n_convs", "n_children", "n_leaves", "saved_tokens",
                             F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")), "trie-sums")
    return _with_parents(out)


def _with_parents(nodes: DataFrame) -> DataFrame:
    """Adds parent_conv_id. Children of hot parents meet them by broadcast, the others by shuffle."""
    parents = nodes.filter("n_children > 0").select(F.col("na").alias("ka"), F.col("nb").alias("kb"), F.col("conv_id").alias("parent_conv_id"),
                                                    F.col("n_children").alias("kids"))
    total = nodes.count()
    hot = F.broadcast(parents.filter(F.col("kids") > HOT_SHARE * total))      # at most 1 / HOT_SHARE nodes
    rest = parents.filter(F.col("kids") <= HOT_SHARE * total)
    key = (F.col("pa") == F.col("ka")) & (F.col("pb") == F.col("kb"))
    below = nodes.filter("depth > 0")
    root = nodes.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return (below.join(hot, key).select(*cols)
            .unionByName(below.join(hot, key, "left_anti").join(rest, key).select(*cols))
            .unionByName(root.select(*cols)))


def brute_heads(conv_id: int) -> int:
    """:func:`head_turns` in Python (for tests)."""
    return zlib.crc32(str(conv_id).encode()) % HEADS

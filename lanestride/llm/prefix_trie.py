"""Prefix trie of conversations: ROLLUP over positional turn columns, a block of columns at a time."""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanestride.operators.spread import ordered_index
from lanestride.session import stage

COLUMNS = 8  # turns that one ROLLUP looks at
TURN_BUCKET = 64
SHARE = 100  # conversations that share the turns of the first of them
MOST_SHARED = 6
NO_ENDS = hashlib.sha256(b"").hexdigest()


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, seq, turn): each turn's 0-based place and its number, equal for equal (role, text) and only for those; staged.

    ``turn`` also has the code points of the text.  Turns are ordered by ``turn``, null
    first; equal ones by the SHA-256 of their role and text.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("at"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"), F.length(text).cast("long").alias("chars"))
    bucket = F.coalesce(F.floor(F.col("at") / TURN_BUCKET).cast("long"), F.lit(-(1 << 62)))
    placed = ordered_index(rows, ["conv_id"], bucket, [F.col("at").asc_nulls_first(), "digest"], "seq").select("conv_id", F.col("seq").cast("long").alias("seq"), "digest", "chars")
    placed = stage(placed)
    known = stage(placed.groupBy("digest", "chars").agg(F.lit(1).alias("_")).drop("_").withColumn("id", F.monotonically_increasing_id()))
    return stage(placed.join(known.select(F.col("digest"), "id"), "digest").select("conv_id", "seq", F.struct("id", "chars").alias("turn")))


def rebuilt(turns: DataFrame, share: int = SHARE, most: int = MOST_SHARED) -> tuple[DataFrame, DataFrame]:
    """(conversations with their length, their turns by place): each begins with up to ``most - 1`` turns of the first of its ``share``.

    The turns taken over are at most five a conversation; a first conversation's are copied to
    at most ``share`` others.
    """
    own = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    heads = (turns.where((F.col("seq") < most - 1) & (F.col("conv_id") % share == 0)).groupBy(F.col("conv_id").alias("base"))
             .agg(F.array_sort(F.collect_list(F.struct("seq", "turn"))).alias("head")))
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    convs = (own.withColumn("h", shared).withColumn("base", F.col("conv_id") - F.col("conv_id") % share).join(heads, "base", "left")
             .withColumn("head", F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.expr("slice(head, 1, 0)"))))
    taken = F.greatest(F.size("head"), F.lit(0)).cast("long")
    convs = stage(convs.withColumn("m", taken).withColumn("length", F.col("m") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).select("conv_id", "h", "head", "m", "length"))
    first = convs.select("conv_id", F.posexplode("head").alias("pos", "x")).select("conv_id", F.col("pos").cast("long").alias("pos"), "x.turn")
    rest = (turns.join(convs.select("conv_id", "h", "m"), "conv_id").where("seq >= h")
            .select("conv_id", (F.col("seq") - F.col("h") + F.col("m")).alias("pos"), "turn"))
    return convs.select("conv_id", "length"), first.unionByName(rest)


def blocks_of(turns: DataFrame, columns: int) -> DataFrame:
    """One row for each conversation and block of ``columns`` places: t1, t2, ... and nothing after the end; staged."""
    column = lambda k: F.max(F.when(F.col("pos") % columns == k, F.col("turn"))).alias(f"t{k + 1}")
    return stage(turns.groupBy("conv_id", F.floor(F.col("pos") / columns).cast("int").alias("block")).agg(*map(column, range(columns))))


def rollup(rows: DataFrame, columns: int, values: str) -> DataFrame:
    """``values`` for each node key and each prefix of its block: key, level, path, the prefix's last turn.

    A prefix that goes beyond the end of its rows is no node.
    """
    names = ", ".join(f"t{k}" for k in range(1, columns + 1))
    level = f"{columns} - bit_count(grouping_id(key, {names}))"
    grouped = rows.sparkSession.sql(f"SELECT key, {level} AS level, array({names}) AS turns, {values} FROM {{rows}} GROUP BY key, ROLLUP({names})", rows=rows)
    kept = grouped.where("level = 0 OR get(turns, level - 1) IS NOT NULL")
    return (kept.withColumn("path", F.expr("transform(slice(turns, 1, level), t -> t.id)"))
            .withColumn("chars", F.expr("get(turns, level - 1).chars")).drop("turns"))


def path(columns: int, level: str) -> F.Column:
    return F.expr("transform(slice(array(" + ", ".join(f"t{k}" for k in range(1, columns + 1)) + f"), 1, {level}), t -> t.id)")


def prefix_trie(conversations: DataFrame, columns: int = COLUMNS, share: int = SHARE, most: int = MOST_SHARED) -> tuple[DataFrame, DataFrame]:
    """(nodes, ends) of the trie of all rebuilt conversations.

    A node is a distinct sequence of first turns, known by its smallest member
    (``conv_id``) and its ``depth``: parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens.  ``ends`` has (conv_id, depth, member) for every conversation, at the
    node that it ends at.

    Rows with a null conv_id are left out.  The first conversation of a negative
    id's share is that of SQL's remainder, nearer to zero.  Null roles and texts count as
    empty; repeated rows are turns of their own.  An empty table has no node, not even a root.

    All prefixes of a block of ``columns`` turns are aggregated by one ROLLUP;
    a node's members go on to the next block under the node's key as long as there
    are two or more.  A conversation that is alone at a node shares nothing
    below it, so the rest of it is a chain of nodes taken from its own turns.
    Subtree sums are a second ROLLUP over the nodes, from the last block up.
    The number of rounds is the longest shared prefix divided by ``columns``.
    """
    turns = numbered_turns(conversations)
    convs, placed = rebuilt(turns, share, most)
    wide = blocks_of(placed, columns)
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"))
    begin, count = root.first()
    if not count:
        return _empty(conversations, NODES), _empty(conversations, ENDS)
    ends = [convs.where("length = 0").select(F.lit(begin).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.col("conv_id").alias("member"))]
    active = stage(wide.where("block = 0").join(convs, "conv_id").withColumn("key", F.lit(begin).cast("long")).drop("block"))
    levels, chains, block = [], [], 0
    while True:
        base = block * columns
        found = stage(rollup(active, columns, "min(conv_id) AS conv_id, count(*) AS n, max(length) AS length").where("level > 0"))
        above = found.where(f"n > 1 AND level < {columns}").select("key", (F.col("level") + 1).alias("level"), F.col("path").alias("up"), F.col("conv_id").alias("parent"))
        up = F.expr("slice(path, 1, level - 1)")
        nodes = (found.where("n > 1").withColumn("up", up).join(above, ["key", "level", "up"], "left")
                 .withColumn("parent", F.coalesce("parent", F.when(F.col("level") == 1, F.col("key")))).drop("up"))
        alone = (found.where("n = 1").withColumn("up", up).join(above, ["key", "level", "up"], "left")
                 .withColumn("top", F.col("parent").isNotNull() | (F.col("level") == 1))
                 .withColumn("parent", F.coalesce("parent", F.when(F.col("level") == 1, F.col("key")).otherwise(F.col("conv_id")))).drop("up"))
        here = stage(nodes.withColumn("top", F.lit(True)).unionByName(alone).withColumn("depth", (F.col("level") + base).cast("long")))
        levels.append(here)
        shared = here.where("n > 1")
        last = active.where(f"length <= {base + columns}")
        ends.append(last.withColumn("level", (F.col("length") - base).cast("int")).withColumn("path", path(columns, "level"))
                    .join(shared.select("key", "level", "path", F.col("conv_id").alias("node")), ["key", "level", "path"])
                    .select(F.col("node").alias("conv_id"), F.col("length").alias("depth"), F.col("conv_id").alias("member")))
        onward = (active.where(f"length > {base + columns}").select("conv_id", "length", "key", path(columns, str(columns)).alias("path"))
                  .join(here.where(f"level = {columns} AND n > 1").select("key", "path", F.col("conv_id").alias("node")), ["key", "path"])
                  .select("conv_id", "length", F.col("node").alias("key")))
        chains.append(here.where(f"n = 1 AND level = {columns} AND length > depth").select("conv_id", F.col("depth").alias("beyond"), "length"))
        block += 1
        active = stage(onward.join(wide.where(F.col("block") == block).drop("block"), "conv_id"))
        if active.isEmpty():
            break
    return trie_sums(levels, chains, placed, begin, count, columns), _union(ends + [_lone_ends(levels, chains)])


NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
ENDS = "conv_id long, depth long, member long"


def _empty(like: DataFrame, schema: str) -> DataFrame:
    return like.sparkSession.createDataFrame([], schema)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _lone_ends(levels: list[DataFrame], chains: list[DataFrame]) -> DataFrame:
    """The ends of conversations that are alone at theirs."""
    found = [here.where("n = 1 AND depth = length").select("conv_id", "depth", F.col("conv_id").alias("member")) for here in levels]
    return _union(found + [c.select("conv_id", F.col("length").alias("depth"), F.col("conv_id").alias("member")) for c in chains])


def trie_sums(levels: list[DataFrame], chains: list[DataFrame], placed: DataFrame, begin: int, count: int, columns: int) -> DataFrame:
    """All nodes with their children, leaves and saved code points."""
    children = _union([here.where("top").select(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth")) for here in levels])
    children = stage(children.groupBy("conv_id", "depth").agg(F.count("*").alias("n_children")))
    done, below = [], None
    for here in reversed(levels):
        shared = (here.where("n > 1").join(children, ["conv_id", "depth"], "left").fillna(0, ["n_children"])
                  .withColumn("leaves", (F.col("n_children") == 0).cast("long")).withColumn("saved", (F.col("n") - 1) * F.col("chars")))
        if below is not None:
            under = below.select(F.col("key").alias("conv_id"), F.lit(columns).alias("level"), F.col("leaves").alias("more"), F.col("save").alias("kept"))
            shared = (shared.join(under, ["conv_id", "level"], "left").withColumn("leaves", F.col("leaves") + F.coalesce("more", F.lit(0)))
                      .withColumn("saved", F.col("saved") + F.coalesce("kept", F.lit(0))).drop("more", "kept"))
        shared = stage(shared)
        single = here.where("n = 1 AND top").select("key", "path", F.lit(1).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"))
        rows = shared.select("key", "path", "leaves", "saved").unionByName(single)
        turn = lambda k: F.when(F.get("path", F.lit(k)).isNotNull(), F.struct(F.get("path", F.lit(k)).alias("id"), F.lit(0).cast("long").alias("chars"))).alias(f"t{k + 1}")
        sums = stage(rollup(rows.select("key", "leaves", "saved", *map(turn, range(columns))), columns, "sum(leaves) AS leaves, sum(saved) AS save").drop("chars"))
        done.append(shared.drop("leaves", "saved").join(sums.where("level > 0"), ["key", "level", "path"])
                    .select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", F.col("leaves").alias("n_leaves"), F.col("save").alias("saved_tokens")))
        below = sums.where("level = 0")
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    for here in levels:
        done.append(here.where("n = 1").select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), one.alias("n_convs"),
                                               (F.col("length") > F.col("depth")).cast("long").alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens")))
    rest = placed.join(_union(chains), "conv_id").where("pos >= beyond")
    done.append(rest.select("conv_id", (F.col("pos") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"), one.alias("n_convs"),
                            (F.col("pos") + 1 < F.col("length")).cast("long").alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens")))
    number = children.where("depth = 0").select("n_children")
    top = (below.agg(F.coalesce(F.sum("leaves"), F.lit(0)).alias("leaves"), F.coalesce(F.sum("save"), F.lit(0)).alias("saved_tokens"))
           .crossJoin(number.agg(F.coalesce(F.sum("n_children"), F.lit(0)).alias("n_children"))))
    done.append(top.select(F.lit(begin).cast("long").alias("conv_id"), zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), F.lit(count).cast("long").alias("n_convs"),
                           F.col("n_children"), F.greatest(F.col("leaves"), F.lit(1).cast("long")).alias("n_leaves"), F.col("saved_tokens")))
    return _union(done)


def end_digests(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256): the digest of a node's members that end there, in ascending order.

    A node's members stream through one task in order, in constant memory; a node with a
    single one never leaves the JVM.
    """
    counted = ends.groupBy("conv_id", "depth").agg(F.count("*").alias("n"), F.min("member").alias("member"))
    single = counted.where("n = 1").select("conv_id", "depth", F.sha2(F.col("member").cast("string"), 256).alias("ends_sha256"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out: list[tuple] = []
            for here in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if here[:2] != node:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = here[:2], hashlib.sha256(str(here[2]).encode())
                else:
                    state.update(b",%d" % here[2])
            yield _digest_rows(out)
        if node is not None:
            yield _digest_rows([(*node, state.hexdigest())])

    several = ends.join(counted.where("n > 1").select("conv_id", "depth"), ["conv_id", "depth"], "left_semi")
    ordered = several.select("conv_id", "depth", "member").repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "member")
    return single.unionByName(ordered.mapInArrow(run, "conv_id long, depth long, ends_sha256 string"))


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())], ["conv_id", "depth", "ends_sha256"])


def trie_nodes(conversations: DataFrame, columns: int = COLUMNS) -> DataFrame:
    """The nodes of ``prefix_trie`` with ``ends_sha256``."""
    nodes, ends = prefix_trie(conversations, columns)
    return (nodes.join(end_digests(ends), ["conv_id", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS))))


_STEP = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
#: For turns that are unique in their conversation.
TRIE_SQL = f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS seq, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % {SHARE} AS base,
  xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN string_split(conv_id::VARCHAR, '')]), lambda a, b: {_STEP}), 4294967295) % {MOST_SHARED} AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
a AS (SELECT c.conv_id, t.seq AS pos, role, text FROM c JOIN t ON t.conv_id = c.base AND t.seq < c.h),
m AS (SELECT c.conv_id, c.h, count(a.pos) AS m FROM c LEFT JOIN a ON a.conv_id = c.conv_id GROUP BY ALL),
r AS (SELECT * FROM a UNION ALL SELECT t.conv_id, t.seq - m.h + m.m, role, text FROM t JOIN m ON m.conv_id = t.conv_id WHERE t.seq >= m.h),
l AS (SELECT c.conv_id, count(r.pos) AS len, coalesce(list({{'r': role, 't': text}} ORDER BY pos) FILTER (r.pos IS NOT NULL), []) AS turns FROM c LEFT JOIN r ON r.conv_id = c.conv_id GROUP BY c.conv_id),
x AS (SELECT conv_id, len, unnest(range(len + 1)) AS depth, turns FROM l),
y AS (SELECT conv_id, len, depth, turns[1:depth] AS p FROM x),
n AS (SELECT depth, p, min(conv_id) AS node, count(*) AS n_convs, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len = depth) AS ends FROM y GROUP BY depth, p),
u AS (SELECT n.*, q.node AS parent FROM n LEFT JOIN n q ON q.depth = n.depth - 1 AND q.p = n.p[1:n.depth - 1]),
k AS (SELECT parent AS node, depth - 1 AS depth, count(*) AS n_children FROM u WHERE parent IS NOT NULL GROUP BY ALL),
v AS (SELECT u.node, u.depth, u.p, u.parent, u.n_convs, u.ends, coalesce(k.n_children, 0) AS n_children,
  CASE WHEN u.depth = 0 THEN 0 ELSE (u.n_convs - 1) * length(u.p[u.depth].t) END AS saved FROM u LEFT JOIN k ON k.node = u.node AND k.depth = u.depth),
s AS (SELECT a.node, a.depth, sum((b.n_children = 0)::INT) AS n_leaves, sum(b.saved) AS saved_tokens FROM v a JOIN y ON y.conv_id >= a.node AND y.len >= a.depth AND y.depth >= a.depth
  JOIN v b ON b.node = y.conv_id AND b.depth = y.depth WHERE b.p[1:a.depth] = a.p GROUP BY a.node, a.depth)
SELECT v.node AS conv_id, v.depth::BIGINT AS depth, v.parent AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM v JOIN s ON s.node = v.node AND s.depth = v.depth
"""

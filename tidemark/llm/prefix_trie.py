"""Conversation prefix trie (13): centroid decomposition of the parent-edge forest.

A node is a distinct sequence of first turns.  Its fingerprint is the XOR of 128 bits per
turn, hashed from (depth, role, text); XOR is associative, so ``scan`` runs it along a
conversation of any length and cuts hot ones.  A node's parent is its fingerprint without its
last turn, so parent edges need no join.

Sums over subtrees come from a centroid decomposition.  Without the root the trie is a forest;
each tree is a component.  A component's centroid is its deepest node that holds at least half
of the component's rows below it.  Removing it leaves the trees of its children and the rest
around the top, each with at most half of the rows.  What hangs under the centroid is totalled
once per component and added to each node on the path from the centroid to the component's top;
the same is then done within the parts.  Every pair of a node and a node below it is parted at
exactly one centroid, which lies on the path between them, so each sum is whole, and no node is
handled more often than log2(rows) times, however deep the trie is.

Rows below a node (``weight``) are the sum of what its members have from there on, one grouped
sum; the paths' weights are lowered as centroids go.  Components of more than ``LOCAL_ROWS``
rows are split by rounds of joins, each a written table; the smaller ones are finished many at
a time inside tasks by the same rule on arrays.  Conversations that end at a node are joined
into strings of at most ``CHUNK_IDS`` ids by ranges of conv_id, and these are digested in order
as a stream, so the node where most conversations end costs few rows and no memory.

Cases: a null conv_id names no conversation, its rows are left out; null turns come first; equal
turns go by role, then by a hash of role and text; null role or text is empty; repeated rows are
turns of their own; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import cut, read_table, releasing
from tidemark.plans.scan import keyed_order_stats, row_number, scan

#: Fixed values of the rebuilding: conversations of a block share the first one's opening turns.
BLOCK, HEADS = 20, 4
#: Rows of a component that one task finishes; rows of a batch of components.
LOCAL_ROWS = 1 << 16
#: Ids of conversations in one string.
CHUNK_IDS = 1 << 12
WORD = r"[^\x20\x09-\x0D]+"
NO_ENDS = hashlib.sha256(b"").hexdigest()


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv, pos, h1, h2, words``: the turns of each conversation, numbered from 1."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.xxhash64(F.lit(1), role, text).alias("h1"),
        F.xxhash64(F.lit(2), role, text).alias("h2"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    stats = keyed_order_stats(rows.select("conv", "turn"), ["turn"], ["conv"])[1]["turn"]
    out = row_number(rows, "pos", ["turn", "role", "h1", "h2"], ["conv"], stats=stats)
    return cut(out.select("conv", "pos", "h1", "h2", "words"), "turns")


def rebuilt(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """``turns`` of every conversation after its block's opening replaced its own first ones."""
    h = F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(HEADS))
    own = turns.where(F.col("pos") > h)
    opening = turns.where(F.col("pos") < HEADS).withColumnRenamed("conv", "base")
    taken = convs.select("conv", (F.col("conv") - F.pmod("conv", F.lit(BLOCK))).alias("base"), h.alias("h"))
    heads = taken.join(opening, "base").where(F.col("pos") <= F.col("h")).select(*turns.columns)
    return own.unionByName(heads)


def prefix_rows(turns: DataFrame) -> DataFrame:
    """One row per conversation and depth: the node's fingerprint, its parent's, its tree's top.

    ``rem`` counts the turns from here to the conversation's end.
    """
    stats = keyed_order_stats(turns.select("conv", "pos"), ["pos"], ["conv"])[1]["pos"]
    deep = row_number(turns, "depth", ["pos"], ["conv"], stats=stats)
    lanes = deep.withColumns({f"l{k}": F.xxhash64(F.lit(2 + k), "depth", "h1", "h2") for k in (1, 2)})
    aggs = {
        "f1": ("xor", F.col("l1")),
        "f2": ("xor", F.col("l2")),
        "top": ("min", F.struct("depth", "l1", "l2")),
    }
    marked = scan(lanes, ["pos"], aggs, ["conv"], inclusive=True, stats=stats)
    counted = scan(marked, ["pos"], {"rem": ("sum", F.lit(1))}, ["conv"], following=True, inclusive=True, stats=stats)
    return counted.select(
        "conv", F.col("depth").cast("long").alias("depth"), "f1", "f2",
        F.col("f1").bitwiseXOR(F.col("l1")).alias("p1"), F.col("f2").bitwiseXOR(F.col("l2")).alias("p2"),
        F.col("top.l1").alias("c1"), F.col("top.l2").alias("c2"), "words", F.col("rem").cast("long").alias("rem"),
    )


def trie_nodes(rows: DataFrame) -> DataFrame:
    """One row per node below the root, with its members, children and what it adds to sums."""
    same = ["depth", "p1", "p2", "c1", "c2", "words"]
    nodes = rows.groupBy("f1", "f2").agg(
        F.min("conv").alias("rep"), F.count("*").alias("n_convs"), F.sum("rem").alias("weight"),
        *[F.max(c).alias(c) for c in same],
    )
    # children are counted by one grouped sum over nodes and parent edges, no join
    zero = F.lit(0).cast("long")
    edges = nodes.where(F.col("depth") > 1).select(F.col("p1").alias("f1"), F.col("p2").alias("f2"), F.lit(1).cast("long").alias("n_children"))
    both = cut(nodes, "nodes")
    whole = both.withColumn("n_children", zero).unionByName(edges, allowMissingColumns=True)
    facts = [c for c in both.columns if c not in ("f1", "f2")]
    counted = whole.groupBy("f1", "f2").agg(*[F.max(c).alias(c) for c in facts], F.sum("n_children").alias("n_children"))
    return counted.withColumns(
        {
            "leaves": (F.col("n_children") == 0).cast("long"),
            "saved": (F.col("n_convs") - 1) * F.col("words"),
            "sum_leaves": zero,
            "sum_saved": zero,
            "c_depth": F.lit(1).cast("long"),
        }
    ).drop("words")


def split_round(nodes: DataFrame, rows: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """One centroid of every component is removed: ``(other nodes, removed centroids)``.

    The nodes are those of components of more than ``most`` rows.
    """
    total = nodes.groupBy("c1", "c2").agg(F.max("weight").alias("total"))
    z = (
        nodes.join(total, ["c1", "c2"])
        .where(2 * F.col("weight") >= F.col("total"))
        .groupBy("c1", "c2")
        .agg(F.max(F.struct("depth", "f1", "f2", "rep", "weight", "c_depth")).alias("z"))
    )
    z = cut(z, "centroids")
    # the step below the centroid on the way to each node, if it lies under the centroid
    below = rows.select(
        F.col("conv").alias("rep"), F.col("depth").alias("b_depth"),
        F.struct("f1", "f2", "p1", "p2").alias("below"),
    )
    placed = nodes.join(z, ["c1", "c2"]).withColumn("b_depth", F.col("z.depth") + 1).join(below, ["rep", "b_depth"], "left")
    is_z = (F.col("f1") == F.col("z.f1")) & (F.col("f2") == F.col("z.f2"))
    under = (
        (F.col("depth") > F.col("z.depth")) & (F.col("below.p1") == F.col("z.f1")) & (F.col("below.p2") == F.col("z.f2"))
    )
    placed = cut(placed.withColumns({"is_z": is_z, "under": F.coalesce(under, F.lit(False))}), "placed")
    gain = placed.where(F.col("is_z") | F.col("under")).groupBy("c1", "c2").agg(
        F.sum("leaves").alias("d_leaves"), F.sum("saved").alias("d_saved"), F.max("z").alias("z")
    )
    path = rows.select("conv", "depth", "f1", "f2").join(gain, F.col("conv") == F.col("z.rep")).where(
        F.col("depth").between(F.col("z.c_depth"), F.col("z.depth"))
    )
    path = path.select("f1", "f2", "d_leaves", "d_saved", F.col("z.weight").alias("d_weight"))
    none = lambda c: F.coalesce(F.col(c), F.lit(0))
    moved = placed.join(path, ["f1", "f2"], "left").withColumns(
        {
            "sum_leaves": F.col("sum_leaves") + none("d_leaves"),
            "sum_saved": F.col("sum_saved") + none("d_saved"),
            "weight": F.col("weight") - none("d_weight"),
            "c1": F.when(F.col("under"), F.col("below.f1")).otherwise(F.col("c1")),
            "c2": F.when(F.col("under"), F.col("below.f2")).otherwise(F.col("c2")),
            "c_depth": F.when(F.col("under"), F.col("b_depth")).otherwise(F.col("c_depth")),
        }
    )
    done = cut(moved.select(*nodes.columns, "is_z"), "split")
    return done.where(~F.col("is_z")).drop("is_z"), done.where("is_z").drop("is_z")


def centroid_sums(parent: np.ndarray, depth: np.ndarray, weight: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Subtree sums of ``values`` (a row per node) over a forest of arrays.

    ``parent`` is the index of the parent, -1 for tops; ``weight`` the sum over a node's subtree
    of any positive weights.  All components advance by one centroid at a time.
    """
    n = len(parent)
    sums, weight = np.zeros_like(values), weight.copy()
    top = np.full(n, -1)  # the component of a node: the index of its top
    by_depth = np.argsort(depth, kind="stable")
    for nodes in np.split(by_depth, np.flatnonzero(np.diff(depth[by_depth])) + 1):
        up = parent[nodes]
        top[nodes] = np.where(up < 0, nodes, top[up])
    live = np.arange(n)
    while len(live):
        heavy = live[2 * weight[live] >= weight[top[live]]]
        centroid = np.full(n, -1)  # by top; the deepest comes last
        heavy = heavy[np.argsort(depth[heavy], kind="stable")]
        centroid[top[heavy]] = heavy
        tops = np.flatnonzero(centroid >= 0)
        z = centroid[tops]
        gone = np.zeros(n, bool)
        gone[z] = True
        # new components, from the tops down
        new = np.full(n, -1)
        below = depth[live] - depth[top[live]]
        by_depth = live[np.argsort(below, kind="stable")]
        for nodes in np.split(by_depth, np.flatnonzero(np.diff(np.sort(below))) + 1):
            up = parent[nodes]
            inside = (nodes != top[nodes]) & ~gone[up]
            new[nodes] = np.where(gone[nodes], -1, np.where(inside, new[up], nodes))
        # what lies under the centroid: itself, and components whose top hangs on it
        under = gone[live] | ((new[live] != top[live]) & (new[live] >= 0))
        gain = np.zeros((n, values.shape[1]), values.dtype)
        np.add.at(gain, top[live[under]], values[live[under]])
        lost, at, of = weight[z], z, tops
        while len(at):
            sums[at] += gain[of]
            weight[at] -= lost
            on = at != of
            at, of, lost = parent[at[on]], of[on], lost[on]
        top = new
        live = live[~gone[live]]
    return sums


def local_sums(nodes: DataFrame) -> DataFrame:
    """``nodes`` of whole components of at most ``LOCAL_ROWS`` rows, with their sums added."""

    def finish(t: pa.Table) -> list[pa.RecordBatch]:
        col = {c: t.column(c).to_numpy() for c in ("f1", "f2", "p1", "p2", "c1", "c2", "depth", "c_depth", "weight")}
        key = np.dtype([("a", np.int64), ("b", np.int64)])
        pack = lambda a, b: np.rec.fromarrays([col[a], col[b]], dtype=key)
        own = pack("f1", "f2")
        order = np.argsort(own, order=["a", "b"])
        wanted = pack("p1", "p2")
        # both keys to dense numbers, so that one binary search finds the parent
        dense = np.unique(np.concatenate([own, wanted]), return_inverse=True)[1]
        mine, theirs = dense[: len(own)], dense[len(own) :]
        at = np.minimum(np.searchsorted(mine[order], theirs), len(own) - 1)
        parent = np.where((mine[order][at] == theirs) & (col["depth"] > col["c_depth"]), order[at], -1)
        values = np.stack([t.column(c).to_numpy() for c in ("leaves", "saved")], axis=1)
        sums = centroid_sums(parent, col["depth"], col["weight"], values)
        for k, c in enumerate(("sum_leaves", "sum_saved")):
            at = t.schema.get_field_index(c)
            t = t.set_column(at, c, pa.array(t.column(c).to_numpy() + sums[:, k]))
        return t.to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # whole components, then the one that goes on
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < LOCAL_ROWS:
                continue
            t = pa.Table.from_batches(held)
            c1, c2 = t.column("c1").to_numpy(), t.column("c2").to_numpy()
            last = np.flatnonzero((c1 != c1[-1]) | (c2 != c2[-1]))
            end = int(last[-1]) + 1 if len(last) else 0
            if end:
                yield from finish(t.slice(0, end).combine_chunks())
                held = t.slice(end).combine_chunks().to_batches()
        if held:
            yield from finish(pa.Table.from_batches(held).combine_chunks())

    return (
        nodes.repartition("c1", "c2").sortWithinPartitions("c1", "c2").mapInArrow(releasing(run), nodes.schema)
    )


def subtree_sums(nodes: DataFrame, rows: DataFrame, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """``nodes`` with ``sum_leaves`` and ``sum_saved`` over their subtrees."""
    done, small, rest = [], [], nodes
    while True:
        tops = rest.where(F.col("depth") == F.col("c_depth"))
        heavy = cut(tops.where(F.col("weight") > local_rows).select("c1", "c2"), "heavy")
        if heavy.isEmpty():
            small.append(rest)
            break
        small.append(rest.join(heavy, ["c1", "c2"], "left_anti"))
        rest, centroids = split_round(rest.join(heavy, ["c1", "c2"], "left_semi"), rows, local_rows)
        done.append(centroids)
    out = small[0]
    for part in small[1:]:
        out = out.unionByName(part)
    out = local_sums(out)
    for part in done:
        out = out.unionByName(part)
    return out


def end_digests(ends: DataFrame) -> DataFrame:
    """``f1, f2, ends_sha256`` from one row ``f1, f2, conv`` per conversation."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, out = None, [], []

        def close() -> None:
            if ids:
                out.append((*key, ids[0], ",".join(map(str, ids))))

        for batch in batches:
            for f1, f2, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if key != (f1, f2) or len(ids) == CHUNK_IDS:
                    close()
                    key, ids = (f1, f2), []
                ids.append(conv)
            yield pa.RecordBatch.from_pylist([dict(zip(("f1", "f2", "first", "ids"), o)) for o in out], parts)
            out.clear()
        close()
        yield pa.RecordBatch.from_pylist([dict(zip(("f1", "f2", "first", "ids"), o)) for o in out], parts)

    parts = pa.schema([("f1", pa.int64()), ("f2", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
    names = pa.schema([("f1", pa.int64()), ("f2", pa.int64()), ("ends_sha256", pa.string())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha, out = None, None, []
        for batch in batches:
            for f1, f2, text in zip(*(batch.column(c).to_pylist() for c in ("f1", "f2", "ids"))):
                if key == (f1, f2):
                    sha.update(b"," + text.encode())
                    continue
                if sha is not None:
                    out.append((*key, sha.hexdigest()))
                key, sha = (f1, f2), hashlib.sha256(text.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(names.names, o)) for o in out], names)
            out.clear()
        if sha is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(names.names, (*key, sha.hexdigest())))], names)

    ranges = ends.select("f1", "f2", "conv").repartitionByRange("conv").sortWithinPartitions("f1", "f2", "conv")
    chunks = ranges.mapInArrow(join, "f1 long, f2 long, first long, ids string")
    ordered = chunks.repartition("f1", "f2").sortWithinPartitions("f1", "f2", "first")
    return ordered.mapInArrow(digest, "f1 long, f2 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """All nodes of the rebuilt conversations' trie, as the query returns them."""
    turns = numbered_turns(conversations)
    convs = cut(turns.select("conv").distinct(), "convs")
    rows = cut(prefix_rows(cut(rebuilt(turns, convs), "rebuilt")), "prefixes")
    nodes = cut(subtree_sums(cut(trie_nodes(rows), "trie"), rows, local_rows), "sums")

    zero = F.lit(0).cast("long")
    number = lambda c: c.cast("long")
    members = convs.select(F.col("conv").alias("conv_id"), F.lit(1).alias("n_convs"))
    tops = nodes.select(
        F.lit(0).alias("n_convs"), number(F.col("depth") == 1).alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
    )
    total = members.unionByName(tops, allowMissingColumns=True).agg(
        F.min("conv_id").alias("conv_id"), *[F.coalesce(F.sum(c), zero).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    )
    root = total.where("n_convs > 0").select(
        "conv_id", zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children",
        F.greatest("n_leaves", F.lit(1)).alias("n_leaves"), "saved_tokens", zero.alias("f1"), zero.alias("f2"),
    )
    root = cut(root, "root")
    first = root.select("conv_id").first()
    parents = nodes.where("n_children > 0").select(F.col("f1").alias("p1"), F.col("f2").alias("p2"), F.col("rep").alias("parent_conv_id"))
    opened = nodes.where("depth = 1").withColumn("parent_conv_id", F.lit(first["conv_id"] if first else None).cast("long"))
    deeper = nodes.where("depth > 1").join(parents, ["p1", "p2"])
    below = opened.unionByName(deeper).select(
        F.col("rep").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children",
        F.col("sum_leaves").alias("n_leaves"), F.col("sum_saved").alias("saved_tokens"), "f1", "f2",
    )
    turnless = convs.join(rows.where("depth = 1").select("conv"), "conv", "left_anti")
    ends = rows.where("rem = 1").select("f1", "f2", "conv").unionByName(turnless.select(zero.alias("f1"), zero.alias("f2"), "conv"))
    digests = end_digests(ends)
    longs = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    return (
        root.unionByName(below)
        .join(digests, ["f1", "f2"], "left")
        .select(*[number(F.col(c)).alias(c) for c in longs], F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read_table(spark, sf_dir, "conversations"))


# crc32 by a fold over the bytes of the decimal conv_id, each followed by eight shifts
_CRC = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length(conv::VARCHAR) + 1), "
    "lambda i: list_prepend(ascii(substr(conv::VARCHAR, i, 1))::BIGINT, list_transform(range(8), lambda j: -1::BIGINT))))), "
    "lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x) ELSE xor(acc >> 1, (acc & 1) * 3988292384) END), 4294967295)"
)

ORACLE = f"""WITH turns AS (SELECT conv_id AS conv, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv, conv - conv % {BLOCK} AS base, {_CRC} % {HEADS} AS h FROM (SELECT DISTINCT conv FROM turns)),
parts AS (SELECT t.conv, t.pos, t.role, t.text FROM turns t JOIN convs c ON t.conv = c.conv WHERE t.pos > c.h
  UNION ALL SELECT c.conv, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv = c.base AND t.pos <= c.h),
deep AS (SELECT conv, text, row_number() OVER w AS depth, count(*) OVER (PARTITION BY conv) AS n_turns,
  sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER w) AS node FROM parts
  WINDOW w AS (PARTITION BY conv ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
steps AS (SELECT *, lag(node, 1, 'root') OVER (PARTITION BY conv ORDER BY depth) AS parent,
  length(regexp_replace(regexp_replace(' ' || text || ' ', '[^\\x20\\x09-\\x0D]+', 'w', 'g'), '[^w]+', '', 'g')) AS words FROM deep
  UNION ALL SELECT c.conv, NULL, 0, coalesce((SELECT max(n_turns) FROM deep d WHERE d.conv = c.conv), 0), 'root', NULL, 0 FROM convs c),
nodes AS (SELECT node, any_value(parent) AS parent, max(depth) AS depth, min(conv) AS rep, count(*) AS n_convs, max(words) AS words,
  sha256(coalesce(string_agg(CASE WHEN depth = n_turns THEN conv::VARCHAR END, ',' ORDER BY conv), '')) AS ends_sha256
  FROM steps GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
full_nodes AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k ON n.node = k.node),
sums AS (SELECT s.node, sum(CASE WHEN u.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((u.n_convs - 1) * u.words) AS saved_tokens
  FROM full_nodes u JOIN steps s ON s.conv = u.rep AND s.depth <= u.depth GROUP BY s.node)
SELECT n.rep AS conv_id, n.depth::BIGINT AS depth, p.rep AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves::BIGINT AS n_leaves,
  s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN sums s ON s.node = n.node LEFT JOIN nodes p ON p.node = n.parent"""

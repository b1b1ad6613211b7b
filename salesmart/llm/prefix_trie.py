"""The trie of conversation prefixes by truncation peeling.

Conversations wait at the depth where they end. From the deepest one up, what ends at a depth is merged with the nodes
that survive from below, by the chained hash of the whole prefix; every merged group is a node with its final sums. Its
last turn is stripped, and it goes on as a part of its parent. So one pass discovers the nodes and aggregates them.

Many depths can go in one step where the subtrees hanging at a depth are small: those are dealt out whole and peeled
inside tasks, at most TURNS turns (or one conversation) each. A depth where a subtree is larger, such as a first turn
that a third of all conversations share, is one grouping that combines before its shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.common import small_batches, table
from salesmart.session import materialize

#: A subtree of several conversations is peeled inside one task when it has at most so many turns.
TURNS = 1024
#: Ids of conversations that end at one node travel in pieces, one for each range of so many ids.
RANGE = 4096

#: The part of a node: sums over the conversations and nodes below it. ``path`` holds (hash, length) from depth 1 on.
_PART = "conv_id long, depth int, path array<struct<hash: binary, len: long>>, n_convs long, n_children long, n_leaves long, saved long"
_NODE = "hash binary, parent binary, depth int, conv_id long, n_convs long, n_children long, n_leaves long, saved long"


def turn_lists(turns: DataFrame) -> DataFrame:
    """(conv_id, turns) of rows (conv_id, turn, role, text): each conversation's (digest, len) by turn, null first.

    A turn's digest is the SHA-256 of its role's length, role and text; null counts as empty. Rows with the same turn
    come in order of their digests. Only digests and lengths move; rows without a conv_id belong to no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.length(role), F.lit(":"), role, text), 256)
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct("turn", digest.alias("digest"), F.length(text).cast("long").alias("len")).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "conv_id", F.transform("t", lambda t: F.struct(F.unhex(t["digest"]).alias("digest"), t["len"].alias("len"))).alias("turns"))


def _paths(lists: DataFrame) -> DataFrame:
    """(conv_id, depth, path): turns as chained hashes, so that a hash stands for the whole prefix."""
    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = []
            for turns in batch.column("turns").to_pylist():
                last, path = b"", []
                for turn in turns:
                    last = hashlib.blake2b(last + turn["digest"], digest_size=16).digest()
                    path.append({"hash": last, "len": turn["len"]})
                paths.append(path)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array([len(p) for p in paths], pa.int32()),
                 pa.array(paths, pa.list_(pa.struct([("hash", pa.binary()), ("len", pa.int64())])))],
                names=["conv_id", "depth", "path"])

    return lists.mapInArrow(chain, "conv_id long, depth int, path array<struct<hash: binary, len: long>>")


def _hash_at(depth: Column) -> Column:
    return F.when(depth > 0, F.get("path", depth - 1)["hash"]).otherwise(F.lit(b""))


def _ended(paths: DataFrame) -> DataFrame:
    """Distinct conversations with the number of their copies: parts of the nodes where they end."""
    # The pair of longs keeps the grouping in a hash map; the path of the smallest conversation is joined back.
    groups = paths.select(_hash_at(F.col("depth")).alias("end"), "conv_id").groupBy("end").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    zero = F.lit(0).cast("long")
    return paths.join(groups.drop("end"), "conv_id").select(
        "conv_id", "depth", "path", "n_convs", zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved"))


def end_digests(paths: DataFrame) -> DataFrame:
    """(hash, ends_sha256) of nodes where conversations end: the SHA-256 of their ids, ascending, joined by commas.

    Ids are joined in pieces by range first; a node with several pieces streams them through one hash in order, so a
    node where a third of all conversations end takes a row for every RANGE ids and holds one piece at a time.
    """
    pieces = paths.select(_hash_at(F.col("depth")).alias("hash"), "conv_id", F.floor(F.col("conv_id") / RANGE).alias("range"))
    pieces = pieces.groupBy("hash", "range").agg(F.array_sort(F.collect_list("conv_id")).alias("ids")).select(
        "hash", "range", F.array_join(F.col("ids").cast("array<string>"), ",").alias("piece"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, running = None, None

        def done(finished: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in finished], pa.binary()), pa.array([d for _, d in finished], pa.string())],
                names=["hash", "ends_sha256"])

        for batch in batches:
            finished = []
            for node, piece in zip(batch.column("hash").to_pylist(), batch.column("piece").to_pylist()):
                if running is not None and node == at:
                    running.update(b"," + piece.encode())
                else:
                    if running is not None:
                        finished.append((at, running.hexdigest()))
                    at, running = node, hashlib.sha256(piece.encode())
            if finished:
                yield done(finished)
        if running is not None:
            yield done([(at, running.hexdigest())])

    return pieces.repartition("hash").sortWithinPartitions("hash", "range").select("hash", "piece").mapInArrow(
        join, "hash binary, ends_sha256 string")


def _merged(parts: list[dict], length: int) -> dict:
    """A node out of its parts: newly ended conversations and survivors from below, with the last turn's length."""
    node = {name: sum(p[name] for p in parts) for name in ("n_convs", "n_children", "n_leaves", "saved")}
    node["conv_id"] = min(p["conv_id"] for p in parts)
    node["n_leaves"] = node["n_leaves"] if node["n_children"] else 1
    node["saved"] += (node["n_convs"] - 1) * length
    return node


def _stripped(node: dict) -> dict:
    """A node as a part of its parent."""
    return {**node, "n_children": 1}


def peel(parts: list[dict], down_to: int) -> Iterator[tuple[str, dict]]:
    """The nodes deeper than ``down_to`` of parts with one prefix there, and what they leave as a part of that prefix."""
    levels: dict[int, list[dict]] = {}
    for part in parts:
        levels.setdefault(part["depth"], []).append(part)
    for depth in range(max(levels), down_to, -1):
        groups: dict[bytes, list[dict]] = {}
        for part in levels.pop(depth, ()):
            groups.setdefault(part["path"][depth - 1]["hash"], []).append(part)
        above = levels.setdefault(depth - 1, [])
        for key, group in groups.items():
            path = group[0]["path"]
            node = _merged(group, path[depth - 1]["len"])
            yield "node", {**node, "hash": key, "parent": path[depth - 2]["hash"] if depth > 1 else b"", "depth": depth}
            above.append({**_stripped(node), "path": path})
    left = levels[down_to]
    rest = {name: sum(p[name] for p in left) for name in ("n_convs", "n_children", "n_leaves", "saved")}
    yield "rest", {**rest, "conv_id": min(p["conv_id"] for p in left), "depth": down_to, "path": left[0]["path"][:down_to]}


def _peel_subtrees(parts: DataFrame, down_to: int) -> DataFrame:
    """Peel all parts deeper than ``down_to``, the subtrees of each prefix of that depth in one task."""
    node_type = pa.struct([("hash", pa.binary()), ("parent", pa.binary()), ("depth", pa.int32()), ("conv_id", pa.int64()),
                           *((n, pa.int64()) for n in ("n_convs", "n_children", "n_leaves", "saved"))])
    path_type = pa.list_(pa.struct([("hash", pa.binary()), ("len", pa.int64())]))
    rest_type = pa.struct([("conv_id", pa.int64()), ("depth", pa.int32()), ("path", path_type),
                           *((n, pa.int64()) for n in ("n_convs", "n_children", "n_leaves", "saved"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, found = None, [], []

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array([x if kind == "node" else None for kind, x in found], node_type),
                 pa.array([x if kind == "rest" else None for kind, x in found], rest_type)], names=["node", "rest"])
            found.clear()
            return batch

        for batch in batches:
            for row in batch.to_pylist():
                if (key := row.pop("key")) != at:
                    if held:
                        found.extend(peel(held, down_to))
                    at, held = key, []
                held.append(row)
            if len(found) > 10_000:
                yield out()
        if held:
            found.extend(peel(held, down_to))
        yield out()

    keyed = parts.withColumn("key", _hash_at(F.lit(down_to)))
    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(run, f"node struct<{_NODE}>, rest struct<{_PART}>")


def _peel_level(parts: DataFrame, depth: int) -> DataFrame:
    """Peel the parts of one depth by a grouping that combines before its shuffle."""
    at = parts.withColumn("hash", _hash_at(F.lit(depth))).groupBy("hash").agg(
        F.min(F.struct("conv_id", "path")).alias("first"),
        *(F.sum(n).alias(n) for n in ("n_convs", "n_children", "n_leaves", "saved")))
    length = F.get(F.col("first.path"), depth - 1)["len"]
    return at.select(
        "hash", (F.get(F.col("first.path"), depth - 2)["hash"] if depth > 1 else F.lit(b"")).alias("parent"),
        F.lit(depth).alias("depth"), F.col("first.conv_id").alias("conv_id"), "n_convs", "n_children",
        F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"),
        (F.col("saved") + (F.col("n_convs") - 1) * length).alias("saved"),
        F.slice(F.col("first.path"), 1, depth - 1).alias("path"))


def _next_depth(parts: DataFrame, depth: int) -> int | None:
    """The least depth above which every subtree of ``parts`` is small enough for a task; None if there is none."""
    depths, step = [], 1
    while depth - step > 0:
        depths.append(depth - step)
        step *= 2
    depths.append(0)
    tried = parts.select(F.explode(F.array(*(F.lit(d) for d in sorted(set(depths))))).alias("to"), "depth", "path").where("depth > to")
    sizes = tried.groupBy("to", _hash_at(F.col("to")).alias("key")).agg(
        F.count("*").alias("n"), F.sum(F.col("depth") - F.col("to")).alias("turns"))
    large = F.max(F.when(F.col("n") > 1, F.col("turns")).otherwise(0))
    good = sizes.groupBy("to").agg(large.alias("turns")).where(F.col("turns") <= TURNS)
    return good.agg(F.min("to")).first()[0]


def trie_nodes(lists: DataFrame) -> DataFrame:
    """One row per distinct prefix of ``lists`` (conv_id, turns: array of (digest, len)), as ``prefix_trie`` describes."""
    small_batches(lists.sparkSession)
    paths = materialize(_paths(lists))
    waiting = materialize(_ended(paths))
    depth = waiting.agg(F.max("depth")).first()[0]
    if depth is None:
        depth = 0
    found: list[DataFrame] = []
    survivors = None
    while depth > 0:
        here = waiting.where(F.col("depth") <= depth)
        here = here if survivors is None else here.unionByName(survivors)
        target = _next_depth(here, depth)
        if target is not None:
            done = materialize(_peel_subtrees(here.where(F.col("depth") > target), target))
            found.append(done.where("node is not null").select("node.*"))
            survivors, depth = done.where("rest is not null").select("rest.*"), target
        else:
            done = materialize(_peel_level(here.where(F.col("depth") == depth), depth))
            found.append(done.drop("path"))
            depth -= 1
            survivors = done.select(
                "conv_id", F.lit(depth).alias("depth"), "path", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved")
    top = waiting.where("depth = 0")
    top = top if survivors is None else top.unionByName(survivors)
    sums = [F.sum(n).alias(n) for n in ("n_convs", "n_children", "n_leaves", "saved")]
    root = top.agg(F.min("conv_id").alias("conv_id"), *sums).where("conv_id is not null").select(
        F.lit(b"").alias("hash"), F.lit(None).cast("binary").alias("parent"), F.lit(0).alias("depth"), "conv_id", "n_convs",
        "n_children", F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"), "saved")
    nodes = root
    for frame in found:
        nodes = nodes.unionByName(frame)
    nodes = materialize(nodes)
    # The parent of all depth-1 nodes is one row; it is looked up once instead of being the hottest key of a join.
    first = nodes.where("depth = 0").select("conv_id").scalar()
    named = nodes.where("depth > 0").select(F.col("hash").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    deep = nodes.where("depth > 1").join(named, "parent")
    low = nodes.where("depth <= 1").withColumn("parent_conv_id", F.when(F.col("depth") == 1, first))
    empty = hashlib.sha256(b"").hexdigest()
    return low.unionByName(deep).join(end_digests(paths), "hash", "left").select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"), "hash")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The trie of conversations (conv_id, turn, role, text, any more columns): a row per distinct sequence of first turns.

    conv_id is the smallest member, parent_conv_id that of the parent (null for the textless root); n_convs counts the
    members, n_children the children, n_leaves the childless nodes of the subtree; saved_tokens sums (n_convs - 1) times
    the code points of a node's last text over the subtree; ends_sha256 is the digest of the ids that end at the node;
    hash names the node. Null roles and texts count as empty, a null turn comes first, rows with one turn are ordered by
    digest, rows without a conv_id belong to no conversation. An empty table has no nodes.
    """
    return trie_nodes(turn_lists(turns))


def rebuilt(lists: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """``lists`` with each conversation's first h turns replaced by those of conversation c - c % every, if it exists;
    h is the CRC-32 of the id as text, modulo ``most``."""
    heads = lists.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("head"))
    own = lists.withColumn("base", F.col("conv_id") - F.col("conv_id") % every).withColumn(
        "h", (F.crc32(F.col("conv_id").cast("string")) % most).cast("int"))
    nothing = F.slice("turns", 1, 0)
    rest = F.when(F.size("turns") > F.col("h"), F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))).otherwise(nothing)
    head = F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), F.col("h"))).otherwise(nothing)
    return own.join(heads, "base", "left").select("conv_id", F.concat(head, rest).alias("turns"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_nodes(rebuilt(turn_lists(table(spark, sf_dir, "conversations")))).drop("hash")


#: Every prefix of every conversation as a list of turns; sums over a subtree by the prefixes of its nodes.
SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(
           length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), l AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY i) AS turns,
         xor(list_reduce(list_prepend(4294967295::BIGINT,
               list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
             lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
               lambda v, k: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 6 AS h
  FROM t GROUP BY conv_id
), c AS (
  SELECT l.conv_id, list_concat(list_slice(b.turns, 1, l.h), list_slice(l.turns, l.h + 1, len(l.turns))) AS turns
  FROM l LEFT JOIN l b ON b.conv_id = l.conv_id - l.conv_id % 100
), p AS (
  SELECT conv_id, len(turns) AS n, d, list_slice(turns, 1, d) AS path
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM c) x
), n AS (
  SELECT d, path, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * coalesce(length(path[d].text), 0) AS own,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
  FROM p GROUP BY d, path
), k AS (
  SELECT d - 1 AS d, list_slice(path, 1, d - 1) AS path, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL
), w AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON k.d = n.d AND k.path = n.path
), s AS (
  SELECT list_slice(path, 1, a) AS path, a, count(*) FILTER (n_children = 0) AS n_leaves, sum(own) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM w) x GROUP BY ALL
)
SELECT w.conv_id, w.d::BIGINT AS depth, u.conv_id AS parent_conv_id, w.n_convs, w.n_children::BIGINT AS n_children,
       s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, w.ends_sha256
FROM w JOIN s ON s.a = w.d AND s.path = w.path
LEFT JOIN n u ON u.d = w.d - 1 AND u.path = list_slice(w.path, 1, w.d - 1)
"""

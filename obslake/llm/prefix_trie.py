"""Conversation prefix trie: nodes are the distinct sequences of first turns that conversations share.

Digests of prefixes are chained turn by turn, so a node is one 16-byte digest. Distinct digests, with
what their members add up to, come from one aggregate. Sums over subtrees are taken shard by shard: a
shard holds whole subtrees, each of a bounded number of rows, in a minimal-perfect-hash node table. Its
digests get slots, each verified against the digest stored there; counts are scattered into flat
arrays by slot and accumulated through the array of parent slots, deepest nodes first. Nodes above all
shards take the shards' totals and are accumulated in the same way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

from obslake.llm.common import cut

ROOT = bytes(16)
SHARD_ROWS = 1 << 16
TABLE_ROWS = 1 << 20
REBUILT = 8  # most turns that another conversation lends


# --- minimal perfect hash ---------------------------------------------------------------------

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)  # fixed values of a common 64-bit mixer


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    x = keys[:, 0] ^ (keys[:, 1] + np.uint64(level * int(_M1) % (1 << 64)))
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


class NodeTable:
    """Slots 0 .. n-1 for n distinct 16-byte digests.

    Each level hashes the keys that are left into twice as many places; a key alone in its place
    gets it, the others go on to the next level. A key's slot is the rank of its place among all that
    were given away. The digest kept at a slot tells whether a key asked for is one of the table's.
    """

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []
        left, base = keys, 0
        while len(left):
            size = 2 * len(left) + 1
            place = (_mixed(left, len(self.levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            self.levels.append((size, alone, base + np.cumsum(alone) - 1))
            base += int(alone.sum())
            left = left[~alone[place]]
            if len(self.levels) > 64:
                raise ValueError("digests are not distinct")
        self.keys = np.zeros_like(keys)
        self.keys[self._slot(keys)] = keys
        if (self.slots(keys) < 0).any():
            raise ValueError("a digest did not get a slot of its own")

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        rest = np.arange(len(keys))
        for level, (size, alone, rank) in enumerate(self.levels):
            place = (_mixed(keys[rest], level) % np.uint64(size)).astype(np.int64)
            held = alone[place]
            out[rest[held]] = rank[place[held]]
            rest = rest[~held]
        return out

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for those that the table does not hold."""
        out = self._slot(keys)
        known = out >= 0
        known[known] = (self.keys[out[known]] == keys[known]).all(axis=1)
        return np.where(known, out, -1)


def _keys(digests: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(digests.to_pylist()), np.uint64).reshape(-1, 2)


def _accumulate(t: pa.Table) -> pa.Table:
    """Sums over the subtrees of one shard: n_children, n_leaves and saved_tokens of its rows, which
    come with what shards below them add (children, leaves, saved)."""
    keys = _keys(t.column("node"))
    table = NodeTable(keys)
    slot, up = table.slots(keys), table.slots(_keys(t.column("parent")))
    n, depth = len(keys), np.zeros(len(keys), np.int64)
    arrays = {c: np.zeros(n, np.int64) for c in ("children", "leaves", "saved")}
    parent = np.full(n, -1, np.int64)
    depth[slot], parent[slot] = t.column("depth").to_numpy(), up
    parent[(parent == np.arange(n)) | (depth == 0)] = -1  # the root's own digest is its parent
    for c, a in arrays.items():
        a[slot] = t.column(c).to_numpy()
    own = np.zeros(n, np.int64)
    own[slot] = (t.column("n_convs").to_numpy() - 1) * t.column("bytes").to_numpy()
    arrays["saved"] += own
    inside = parent >= 0
    np.add.at(arrays["children"], parent[inside], 1)
    arrays["leaves"][arrays["children"] == 0] = 1
    order = np.argsort(-depth, kind="stable")
    ends = np.flatnonzero(np.diff(depth[order])) + 1
    for level in np.split(order, ends):
        level = level[inside[level]]
        for c in ("leaves", "saved"):
            np.add.at(arrays[c], parent[level], arrays[c][level])
    for c, name in (("children", "n_children"), ("leaves", "n_leaves"), ("saved", "saved_tokens")):
        t = t.append_column(name, pa.array(arrays[c][slot]))
    return t


# --- rebuilt conversations --------------------------------------------------------------------

def _turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos from 1, turn: 16-byte digest of role and text, bytes), turns in order."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    t = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("_turn"), role.alias("_role"),
        F.unhex(F.substring(F.sha2(said, 256), 1, 32)).alias("turn"), F.octet_length(text).cast("long").alias("bytes"))
    order = Window.partitionBy("conv_id").orderBy(F.col("_turn").asc_nulls_first(), "_role", "turn")
    return t.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "turn", "bytes")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, length, own, pos, turn, bytes) of the rebuilt conversations, in the order of
    (own, pos), and all conversations (conv_id, length); see `trie`."""
    turns = cut(_turns(conversations), "turns")
    own_ids = turns.groupBy("conv_id").agg(F.max("pos").alias("_own"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    ids = own_ids.select("conv_id", "_own", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % 5).alias("base"))
    lent = own_ids.select(F.col("conv_id").alias("base"), F.col("_own").alias("_lent"))
    ids = ids.join(lent, "base", "left").withColumn("_lent", F.least("h", F.coalesce("_lent", F.lit(0)))) \
        .withColumn("length", F.col("_lent") + F.greatest(F.lit(0), F.col("_own") - F.col("h")))
    ids = cut(ids.select("conv_id", "base", "h", "length"), "conversations")
    first = turns.where(F.col("pos") <= REBUILT).withColumnRenamed("conv_id", "base")
    before = ids.join(first, "base").where("pos <= h").select("conv_id", "length", F.lit(False).alias("own"), "pos", "turn", "bytes")
    after = ids.drop("base").join(turns, "conv_id").where("pos > h").select("conv_id", "length", F.lit(True).alias("own"), "pos", "turn", "bytes")
    return before.unionByName(after), ids.select("conv_id", "length")


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefix digests of conversations that arrive turn by turn; one digest is held at a time."""
    conv, digest, depth = None, ROOT, 0
    for b in batches:
        nodes, parents, depths = [], [], []
        for c, turn in zip(b.column("conv_id").to_pylist(), b.column("turn").to_pylist()):
            if c != conv:
                conv, digest, depth = c, ROOT, 0
            parents.append(digest)
            digest, depth = hashlib.sha256(digest + turn).digest()[:16], depth + 1
            nodes.append(digest)
            depths.append(depth)
        yield pa.RecordBatch.from_arrays(
            [b.column("conv_id"), b.column("length"), pa.array(depths, pa.int64()), pa.array(nodes, pa.binary()),
             pa.array(parents, pa.binary()), b.column("bytes")], ["conv_id", "length", "depth", "node", "parent", "bytes"])


# --- digests of the conversations that end at a node --------------------------------------------

def _listed(most: int):
    """Sorted rows (node, conv_id) to rows (node, first, ids): decimal ids joined by commas, `most`
    of them in a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([node], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])],
                ["node", "first", "ids"])

        for b in batches:
            for v, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if ids and (v != node or len(ids) >= most):
                    yield out()
                    ids = []
                node = v
                ids.append(c)
        if ids:
            yield out()
    return run


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, ids) sorted by node and first id to (node, ends_sha256)."""
    node, state = None, None
    for b in batches:
        done: list[tuple[bytes, str]] = []
        for v, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if v != node:
                if node is not None:
                    done.append((node, state.hexdigest()))
                node, state = v, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], pa.binary()), pa.array([x for _, x in done], pa.string())],
                                         ["node", "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], ["node", "ends_sha256"])


def _ends(rows: DataFrame, most: int = 4096) -> DataFrame:
    """(node, ends_sha256) of (node, conv_id). However many end at one node, its ids are sorted and
    joined over many tasks; only the joined lists meet in the one task that hashes them in order."""
    lists = rows.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id") \
        .mapInArrow(_listed(most), "node binary, first long, ids string")
    return lists.repartition("node").sortWithinPartitions("node", "first").select("node", "ids") \
        .mapInArrow(_hashed, "node binary, ends_sha256 string")


# --- the trie ---------------------------------------------------------------------------------

def _sums(t: DataFrame) -> DataFrame:
    """Rows of each shard with the sums over their subtrees in it."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in t.schema)
    return t.groupBy("shard").applyInArrow(_accumulate, f"{kinds}, n_children long, n_leaves long, saved_tokens long")


def _added(t: DataFrame, totals: DataFrame) -> DataFrame:
    """Nodes t with the totals of finished subtrees (parent, n_leaves, saved_tokens) added."""
    below = totals.groupBy(F.col("parent").alias("node")).agg(
        F.count("*").alias("_c"), F.sum("n_leaves").alias("_l"), F.sum("saved_tokens").alias("_s"))
    return t.join(below, "node", "left").select(
        *(c for c in t.columns if c not in ("children", "leaves", "saved")),
        *((F.col(c) + F.coalesce(a, F.lit(0))).alias(c) for c, a in (("children", "_c"), ("leaves", "_l"), ("saved", "_s"))))


def trie(conversations: DataFrame, shard_rows: int = SHARD_ROWS, table_rows: int = TABLE_ROWS) -> DataFrame:
    """Prefix trie of conversations (conv_id long, turn, role, text): one row per node, conv_id (its
    smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, node.

    A conversation's turns are ordered by turn, nulls first, and those of equal turn by role and
    by a digest of the text; repeated rows are turns each; a null role or text is empty. Conversation
    c is rebuilt from the first h turns of conversation c - c % 5, if there is one, and its own turns
    after its first h, with h = crc32(decimal c) % 9. The node of depth d stands for the members that start
    with the same d turns, `node` is its digest; all conversations are members of the root, turnless
    ones of it alone. n_children, n_leaves (childless nodes) and saved_tokens (of each node the bytes of
    its last text, for each member but one) are taken over the subtree, its top included; ends_sha256
    is the SHA-256 of the ids of members of exactly d turns. Rows without a conv_id belong to no
    conversation; without conversations there is no node. Other columns are ignored.

    A node of one member whose parent also has one is settled without a table: below it there is
    one leaf and nothing is saved. The others are dealt to shards of about shard_rows nodes by the topmost
    subtrees whose members have shard_rows turns at most below their top. What is above all shards is accumulated from below
    in bands of table_rows nodes.
    """
    turns, convs = rebuilt(conversations)
    rows = turns.repartition("conv_id").sortWithinPartitions("conv_id", "own", "pos") \
        .mapInArrow(_chain, "conv_id long, length long, depth long, node binary, parent binary, bytes long")
    top = F.lit(ROOT)
    rows = cut(rows.unionByName(convs.select("conv_id", "length", F.lit(0).cast("long").alias("depth"), top.alias("node"),
                                             top.alias("parent"), F.lit(0).cast("long").alias("bytes"))), "prefixes")
    nodes = rows.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent").alias("parent"),
        F.count("*").alias("n_convs"), F.first("bytes").alias("bytes"), F.first("length").alias("length"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("mass"))
    nodes = cut(nodes, "nodes")
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"),
                         F.col("n_convs").alias("_n"), F.col("mass").alias("_mass"))
    nodes = cut(nodes.join(above, "parent").withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("parent_conv_id"))), "parented")

    # tails of one conversation below a node of the same one
    tail = F.expr("depth > 0 and _n = 1")
    own_end = F.when(F.col("depth") == F.col("length"), F.col("conv_id").cast("string")).otherwise("")
    tails = nodes.where(tail).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", (F.col("depth") < F.col("length")).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.sha2(own_end, 256).alias("ends_sha256"), "node")

    # a node of one member, its parent shared, is a leaf here; its one child is counted at the end
    held = nodes.where(~tail).select(
        "node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "bytes", "length", "mass", "_mass",
        *(F.lit(0).cast("long").alias(c) for c in ("children", "leaves", "saved")))
    light = F.col("mass") <= shard_rows
    roots = held.where(light).where((F.col("depth") == 0) | (F.col("_mass") > shard_rows)).select("node")
    shard_of = rows.select("conv_id", "node").join(roots.withColumnRenamed("node", "shard"), F.col("node") == F.col("shard")) \
        .select("conv_id", "shard")
    columns = ["node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "length", "n_children", "n_leaves", "saved_tokens"]
    below = held.where(light)
    shards = below.count() // shard_rows + 1
    low = _sums(below.join(shard_of, "conv_id").withColumn("shard", F.pmod(F.xxhash64("shard"), F.lit(shards))).drop("mass", "_mass"))
    done = [cut(low.select(*columns), "shards")]
    open_ = cut(_added(held.where(~light).drop("mass", "_mass"), done[0].join(roots, "node", "left_semi")), "above")
    while (left := open_.count()):
        least, shards = 0, 1
        if left > table_rows:  # the deepest levels that a table holds together
            levels = open_.groupBy("depth").agg(F.count("*").alias("n"))
            upto = F.sum("n").over(Window.orderBy(F.col("depth").desc()))
            deepest, least = levels.withColumn("upto", upto).agg(
                F.max("depth"), F.min(F.when(F.col("upto") <= table_rows, F.col("depth")))).first()
            if least is None:  # a level alone: no node is another's parent, so digests deal it out
                least, shards = deepest, left // table_rows + 1
        band = open_.where(F.col("depth") >= least).withColumn("shard", F.pmod(F.xxhash64("node"), F.lit(shards)))
        done.append(cut(_sums(band).select(*columns), "band"))
        open_ = cut(_added(open_.where(F.col("depth") < least), done[-1].where(F.col("depth") == least)), "above")

    tree = done[0]
    for d in done[1:]:
        tree = tree.unionByName(d)
    ends = rows.where("depth = length").join(tree.select("node"), "node", "left_semi").select("node", "conv_id")
    one = (F.col("n_convs") == 1) & (F.col("depth") < F.col("length"))
    tree = tree.join(_ends(ends), "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.when(one, F.lit(1).cast("long")).otherwise(F.col("n_children")).alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "node")
    return tree.unionByName(tails)

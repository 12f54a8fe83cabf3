"""Prefix trie of conversations in balanced parentheses (operator 12).

Rebuilt conversations are paths of turn keys. Equal paths are counted once,
then dealt by range partitions in path order. A task writes the trie of
each shard of its paths as balanced parentheses: findclose over
range min-max blocks of the excess delimits a subtree, a running count of
leaf pairs "()" gives its leaves, running sums give members and savings.

Nodes off the paths of a shard's first and last row lie in that shard alone and
are done. The two paths are its spine: other shards may share them. Spines
carry what hangs off each of their nodes and are merged as the paths of a
smaller trie, until one shard holds all of them.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from personalens.llm.common import read_table, stored

KEY = 16  # bytes of a turn's key
SPAN, HEADS = 5, 9
#: Path nodes of one shard; a single longer path is a shard of its own.
SHARD_NODES = 1 << 18
#: Spine nodes that are merged by one task at last.
LAST_NODES = 1 << 20
#: Conversation ids that are put into one text before they are hashed.
IDS = 4096
BLOCK = 64
NO_ID = np.iinfo(np.int64).max
NO_ENDS = hashlib.sha256(b"").hexdigest()


# ---------------------------------------------------------------- rebuilding

REBUILT = "conv_id long, key binary, path binary, sizes binary"


def _rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Path (turn keys) and text sizes of each rebuilt conversation, from turns sorted by group, conversation and turn."""
    head: tuple[int, list] = (0, [])  # the group, and the first turns of its base conversation
    conv, keys, sizes, skip, out = None, [], [], 0, []

    def done():
        if conv is not None:
            path = b"".join(keys)
            out.append((conv, hashlib.sha256(path).digest()[:KEY], path, np.array(sizes, "<i4").tobytes()))

    for batch in batches:
        for group, c, key, size in zip(*(batch.column(x).to_pylist() for x in ("base", "conv_id", "key", "size")), strict=True):
            if c != conv:
                done()
                if group != head[0] or not head[1]:
                    head = (group, [])
                conv, h = c, zlib.crc32(str(c).encode()) % HEADS
                first = head[1][:h] if c != group else []
                keys, sizes = [k for k, _ in first], [n for _, n in first]
                skip = h if c != group else 0  # a base conversation is its own head
            if c == group and len(head[1]) < HEADS - 1:
                head[1].append((key, size))
            if skip:
                skip -= 1
            else:
                keys.append(key)
                sizes.append(size)
        if len(out) >= 1000:
            yield _columns(out, REBUILT)
            out.clear()
    done()
    yield _columns(out, REBUILT)


TYPES = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}


def _columns(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, types = zip(*(f.split() for f in schema.split(", ")), strict=True)
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(x, TYPES[t]) for x, t in zip(columns, types, strict=True)], names=list(names))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, key, path, sizes: each conversation with the first turns of its group's base conversation in place of its own.

    Turns are ordered by number (null first), equal numbers by role, then by the text's SHA-256. Null
    roles and texts are empty. Rows without a conv_id belong to no conversation.
    """
    c = conversations
    role, text = F.coalesce(c["role"].cast("string"), F.lit("")), F.coalesce(c["text"].cast("string"), F.lit(""))
    turns = c.select(
        c["conv_id"].cast("long").alias("conv_id"), c["turn"].alias("turn"), role.alias("role"), F.octet_length(text).alias("size"),
        F.substring(F.unhex(F.sha2(text, 256)), 1, KEY).alias("tie"),
        F.substring(F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)), 1, KEY).alias("key"))
    turns = turns.where("conv_id IS NOT NULL").withColumn("base", F.col("conv_id") - F.col("conv_id") % SPAN)
    n = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The base conversation of a group comes first, whatever the sign of its id.
    order = ["base", F.col("conv_id") != F.col("base"), "conv_id", F.col("turn").asc_nulls_first(), "role", "tie"]
    return turns.repartition(n, "base").sortWithinPartitions(*order).select("base", "conv_id", "key", "size").mapInArrow(_rebuilt, REBUILT)


# ---------------------------------------------------------------- members that end at a node

def _id_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Comma-joined ids of runs of one key, from rows sorted by key and id."""
    schema = "key binary, first long, n long, ids binary"
    key, ids, out = None, [], []

    def done():
        if ids:
            out.append((key, ids[0], len(ids), ",".join(map(str, ids)).encode()))

    for batch in batches:
        for k, c in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if k != key or len(ids) == IDS:
                done()
                key, ids = k, []
            ids.append(c)
        if len(out) >= 1000:
            yield _columns(out, schema)
            out.clear()
    done()
    yield _columns(out, schema)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n, least id and SHA-256 of all ids of a key, from its texts in order."""
    schema = "key binary, n long, conv_id long, ends string"
    key, first, n, state, out = None, 0, 0, None, []
    for batch in batches:
        for k, f, m, ids in zip(*(batch.column(x).to_pylist() for x in ("key", "first", "n", "ids")), strict=True):
            if k != key:
                if state:
                    out.append((key, n, first, state.hexdigest()))
                key, first, n, state = k, f, 0, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids)
            n += m
        if len(out) >= 1000:
            yield _columns(out, schema)
            out.clear()
    if state:
        out.append((key, n, first, state.hexdigest()))
    yield _columns(out, schema)


def ends_of(paths: DataFrame) -> DataFrame:
    """key, n, conv_id (least), ends (SHA-256 of the ids in order, comma-joined) of each distinct path.

    Ranges of (key, id) spread the copies of one path over tasks; only texts of IDS ids come together.
    """
    n = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = paths.select("key", "conv_id").repartitionByRange(n, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    texts = ids.mapInArrow(_id_texts, "key binary, first long, n long, ids binary")
    return texts.repartition(n, "key").sortWithinPartitions("key", "first").mapInArrow(_hashed, "key binary, n long, conv_id long, ends string")


# ---------------------------------------------------------------- balanced parentheses

class Parentheses:
    """A forest as balanced parentheses, with the least excess of each block and of each range of blocks above it."""

    def __init__(self, is_open: np.ndarray):
        self.open = is_open
        self.excess = np.cumsum(np.where(is_open, 1, -1))  # after each parenthesis
        blocks = max(1, -(-len(is_open) // BLOCK))
        padded = np.full(blocks * BLOCK, np.iinfo(np.int64).max)
        padded[:len(is_open)] = self.excess
        self.rows = padded.reshape(blocks, BLOCK)
        self.least = [self.rows.min(1)]
        while len(self.least[-1]) > 1:
            x = self.least[-1]
            x = np.append(x, np.iinfo(np.int64).max) if len(x) % 2 else x
            self.least[-1] = x
            self.least.append(np.minimum(x[0::2], x[1::2]))

    def find_close(self, p: np.ndarray) -> np.ndarray:
        """Where each opening parenthesis at p is closed: the first place after it with an excess below its own."""
        target = self.excess[p] - 1
        out = np.full(len(p), -1)
        self._in_block(p // BLOCK, p % BLOCK + 1, target, np.arange(len(p)), out)
        todo = np.flatnonzero(out < 0)
        node, level, want = p[todo] // BLOCK, np.zeros(len(todo), np.int64), target[todo]
        found = np.zeros(len(todo), bool)
        for up in range(len(self.least)):  # up to the first range on the right that holds the target
            at = np.flatnonzero(~found)
            x = self.least[up]
            left = node[at] % 2 == 0
            right = np.minimum(node[at] + 1, len(x) - 1)
            hit = left & (node[at] + 1 < len(x)) & (x[right] <= want[at])
            node[at[hit]] += 1
            level[at[hit]] = up
            found[at[hit]] = True
            node[at[~hit]] //= 2
        for down in range(len(self.least) - 1, 0, -1):  # and down to its first block that does
            at = np.flatnonzero(level == down)
            node[at] *= 2
            node[at] += self.least[down - 1][node[at]] > want[at]
            level[at] = down - 1
        self._in_block(node, np.zeros(len(todo), np.int64), want, todo, out)
        return out

    def _in_block(self, block, start, target, which, out) -> None:
        for a in range(0, len(block), 1 << 14):
            part = slice(a, a + (1 << 14))
            hit = (self.rows[block[part]] <= target[part, None]) & (np.arange(BLOCK) >= start[part, None])
            first = hit.argmax(1)
            ok = hit[np.arange(len(first)), first]
            out[which[part][ok]] = block[part][ok] * BLOCK + first[ok]


class Trie:
    """The trie of sorted paths, its nodes in preorder; node 0 is the root.

    paths: arrays of KEY-byte keys; sizes: bytes of each turn's text.
    """

    def __init__(self, paths: list[bytes], sizes: list[np.ndarray]):
        length = np.array([len(p) // KEY for p in paths])
        shared = np.array([0] + [_common(a, b) for a, b in zip(paths[:-1], paths[1:], strict=True)])
        shared[1:] = np.minimum(shared[1:], length[1:])
        new = length - shared  # nodes that each path adds
        n = 1 + int(new.sum())
        first = 1 + np.cumsum(new) - new  # a path's first new node
        of = np.repeat(np.arange(len(paths)), new)
        self.depth = np.zeros(n, np.int64)
        self.depth[1:] = np.arange(1, n) - first[of] + shared[of] + 1
        self.row = np.concatenate(([0], of))  # a path that holds the node
        self.size = np.zeros(n, np.int64)
        if n > 1:
            self.size[1:] = np.concatenate([s[k:] for s, k in zip(sizes, shared, strict=True)])
        # Between the openings of nodes i - 1 and i as many are closed as the depth falls short of one step.
        closed = np.concatenate((self.depth[:-1] + 1 - self.depth[1:], [self.depth[-1] + 1]))
        self.at = np.arange(n) + np.concatenate(([0], np.cumsum(closed[:-1])))
        is_open = np.zeros(2 * n, bool)
        is_open[self.at] = True
        self.parens = Parentheses(is_open)
        self.last = np.arange(n) + (self.parens.find_close(self.at) - self.at) // 2  # last node of each subtree
        # The parent is the last node before with one step less depth.
        code = self.depth * n + np.arange(n)
        order = np.argsort(code, kind="stable")
        self.parent = order[np.searchsorted(code[order], (self.depth - 1) * n + np.arange(n)) - 1]
        self.parent[0] = -1
        self.end = np.where(new > 0, first + new - 1, 0)  # distinct sorted paths: only an empty one adds no node

    def path_nodes(self, row: int) -> np.ndarray:
        """The nodes of a path, from the root on."""
        node = int(self.end[row])
        out = [node]
        while node:
            node = int(self.parent[node])
            out.append(node)
        return np.array(out[::-1])

    def over_subtree(self, x: np.ndarray) -> np.ndarray:
        """Sum of x over each node's subtree."""
        total = np.concatenate(([0], np.cumsum(x)))
        return total[self.last + 1] - total[:len(x)]

    def leaf_pairs(self) -> np.ndarray:
        """Leaves in each subtree: opening parentheses closed at once, by rank."""
        is_open = self.parens.open
        rank = np.concatenate(([0], np.cumsum(is_open & ~np.append(is_open[1:], False))))
        close = self.at + 2 * (self.last - np.arange(len(self.at))) + 1
        return rank[close + 1] - rank[self.at]

    def least(self, x: np.ndarray) -> np.ndarray:
        """Minimum of x over each node's subtree, from minima over runs of 2**k nodes."""
        out, size = np.empty(len(x), x.dtype), self.last + 1 - np.arange(len(x))
        level, k = x.copy(), 0
        power = np.frexp(size)[1] - 1
        while True:
            at = np.flatnonzero(power == k)
            out[at] = np.minimum(level[at], level[self.last[at] + 1 - (1 << k)])
            if 1 << k + 1 > len(x):
                return out
            level[:len(x) - (1 << k)] = np.minimum(level[:len(x) - (1 << k)], level[1 << k:])
            k += 1


def _common(a: bytes, b: bytes) -> int:
    """Leading keys that two paths share."""
    n = min(len(a), len(b)) // KEY * KEY
    if a[:n] == b[:n]:
        return n // KEY
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    return int((x != y).argmax()) // KEY


# ---------------------------------------------------------------- shards and spines

DONE = ("conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, "
        "parent_conv_id long, own binary, above binary")
#: What hangs off each node of a spine beside the spine: text bytes, members, least member, children, leaves, savings; and ends.
SPINE = "path binary, carried binary, path_ends string"
CARRIED = 6
OUT = f"{DONE}, {SPINE}"


def prefix_keys(path: bytes) -> list[bytes]:
    """A key of the node at each depth of a path."""
    state, out = hashlib.sha256(), []
    out.append(state.digest()[:KEY])
    for k in range(0, len(path), KEY):
        state.update(path[k:k + KEY])
        out.append(state.digest()[:KEY])
    return out


def _first_level(most: int):
    """Nodes and spines of the shards in a task, from distinct rebuilt conversations in path order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def shard(rows):
            paths, sizes, n, conv, ends = zip(*rows, strict=True)
            trie = Trie(list(paths), [np.frombuffer(x, "<i4").astype(np.int64) for x in sizes])
            values = np.zeros((CARRIED - 1, len(trie.depth)), np.int64)
            values[1] = NO_ID
            values[0, trie.end], values[1, trie.end] = n, conv
            return _shard(trie, list(paths), values, dict(zip(trie.end.tolist(), ends, strict=True)), False, False)

        rows, held = [], 0
        for batch in batches:
            for row in zip(*(batch.column(x).to_pylist() for x in ("path", "sizes", "n", "conv_id", "ends")), strict=True):
                rows.append(row)
                held += len(row[0]) // KEY + 1
                if held >= most:
                    yield from shard(rows)
                    rows, held = [], 0
        if rows:
            yield from shard(rows)
    return run


def _next_level(most: int, final: bool):
    """Nodes and spines of the shards in a task, from the level before's spines in path order; final: one shard holds all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def shard(rows):
            paths = [r[0] for r in rows]
            carried = [np.frombuffer(r[1], "<i8").reshape(CARRIED, -1) for r in rows]
            trie = Trie(paths, [x[0, 1:] for x in carried])
            values, ends = np.zeros((CARRIED - 1, len(trie.depth)), np.int64), {}
            values[1] = NO_ID
            for i, x in enumerate(carried):
                nodes = trie.path_nodes(i)
                for k in (0, 2, 3, 4):
                    values[k, nodes] += x[k + 1]
                values[1, nodes] = np.minimum(values[1, nodes], x[2])
                ends |= {n: e for n, e in zip(nodes.tolist(), rows[i][2].split(","), strict=True) if e}
            return _shard(trie, paths, values, ends, True, final)

        rows, held = [], 0
        for batch in batches:
            for row in zip(*(batch.column(x).to_pylist() for x in ("path", "carried", "path_ends")), strict=True):
                rows.append(row)
                held += len(row[0]) // KEY + 1
                if held >= most and not final:
                    yield from shard(rows)
                    rows, held = [], 0
        if rows:
            yield from shard(rows)
    return run


def _shard(trie: Trie, paths: list[bytes], values: np.ndarray, ends: dict[int, str], keyed: bool, final: bool) -> Iterator[pa.RecordBatch]:
    """values: members, least member, children, leaves and savings that hang off each node beside the trie's own nodes.

    keyed: done nodes may stand above nodes of other shards, so they come with their keys.
    """
    members, conv, children, leaves, saved = values
    n = len(trie.depth)
    border = [] if final else sorted({0, len(paths) - 1})
    spines = {i: trie.path_nodes(i) for i in border}
    spine = np.zeros(n, bool)
    for nodes in spines.values():
        spine[nodes] = True
    inner = np.bincount(trie.parent[1:], minlength=n)
    n_children = inner + children
    n_convs, least = trie.over_subtree(members), trie.least(conv)
    no_leaf = (inner == 0) & ((children > 0) | spine)
    n_leaves = trie.leaf_pairs() - trie.over_subtree(no_leaf) + trie.over_subtree(leaves)
    total = trie.over_subtree(saved + np.where(spine, 0, (n_convs - 1) * trie.size))
    keys = {}
    for i in range(len(paths)) if keyed else border:
        keys |= dict(zip(trie.path_nodes(i).tolist(), prefix_keys(paths[i]), strict=True))
    done = np.flatnonzero(~spine)
    above = trie.parent[done]
    pending = (above >= 0) & spine[above]
    names = [f.split()[0] for f in OUT.split(", ")]
    for a in range(0, len(done), 5000):
        part, over, wait = done[a:a + 5000], above[a:a + 5000], pending[a:a + 5000]
        none = pa.nulls(len(part), pa.binary())
        yield pa.RecordBatch.from_arrays([
            *(pa.array(x[part]) for x in (least, trie.depth, n_convs, n_children, n_leaves, total)),
            pa.array([ends.get(i, NO_ENDS) for i in part.tolist()]), pa.array(least[over], mask=wait | (over < 0)),
            pa.array([keys[i] if keyed else None for i in part.tolist()], pa.binary()),
            pa.array([keys[o] if w else None for o, w in zip(over.tolist(), wait.tolist(), strict=True)], pa.binary()),
            none, none, none.cast(pa.string())], names=names)
    given = np.zeros(n, bool)  # nodes on both paths go with the first
    for i, nodes in spines.items():
        own = np.stack([trie.size[nodes], n_convs[nodes], least[nodes], n_children[nodes], n_leaves[nodes], total[nodes]])
        # Without what hangs off the spine's next nodes: on this path, and on the other where the two part.
        for other in spines.values():
            part = [k for k, node in enumerate(nodes.tolist()) if k + 1 < len(other) and other[k] == node]
            for k in part:
                child = other[k + 1]
                if other is nodes or k + 1 >= len(nodes) or child != nodes[k + 1]:
                    own[[1, 4, 5], k] -= [n_convs[child], n_leaves[child], total[child]]
                    own[3, k] -= 1
        twice = given[nodes]
        own[1:, twice] = np.array([0, NO_ID, 0, 0, 0])[:, None]
        none = [pa.nulls(1, pa.int64())] * 6
        yield pa.RecordBatch.from_arrays([
            *none, pa.nulls(1, pa.string()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
            pa.array([paths[i]], pa.binary()), pa.array([own.astype("<i8").tobytes()], pa.binary()),
            pa.array([",".join("" if t else ends.get(k, "") for k, t in zip(nodes.tolist(), twice.tolist(), strict=True))])], names=names)
        given[nodes] = True


def prefix_trie(conversations: DataFrame, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """Every node of the trie of rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    Null roles and texts are empty, rows without a conv_id belong to no conversation, repeated rows are
    turns each (their order: see rebuilt). Very long texts are read as their hash and size
    only. A conversation is one row of 20 bytes a turn. An empty table gives an empty result.
    shard_nodes moves work between tasks, not the result.
    """
    spark = conversations.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    paths = stored(rebuilt(conversations), "rebuilt")
    distinct = paths.select("key", "path", "sizes").dropDuplicates(["key"]).join(ends_of(paths), "key")
    rows = stored(distinct.select("path", "sizes", "n", "conv_id", "ends"), "paths")
    rows = rows.repartitionByRange(n, "path").sortWithinPartitions("path")
    out = stored(rows.mapInArrow(_first_level(shard_nodes), OUT), "trie")
    done, most = out.where("path IS NULL"), shard_nodes
    while True:
        spines = out.where("path IS NOT NULL").select(*[f.split()[0] for f in SPINE.split(", ")])
        nodes = spines.agg(F.sum(F.octet_length("path") / KEY + 1)).first()[0] or 0
        parts = min(n, int(nodes // most) + 1)
        final = parts == 1
        rows = spines.repartitionByRange(parts, "path").sortWithinPartitions("path")
        out = stored(rows.coalesce(1).sortWithinPartitions("path").mapInArrow(_next_level(most, True), OUT) if final
                     else rows.mapInArrow(_next_level(most, False), OUT), "spines")
        done = done.union(out.where("path IS NULL"))
        if final:
            break
        most *= 8  # so that the number of spines shrinks, however long they are
    over = done.where("own IS NOT NULL").select(F.col("own").alias("above"), F.col("conv_id").alias("over_id"))
    done = done.join(over, "above", "left")
    return done.select("conv_id", "depth", F.coalesce("parent_conv_id", "over_id").alias("parent_conv_id"), "n_convs", "n_children",
                       "n_leaves", "saved_tokens", F.col("ends").alias("ends_sha256"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read_table(spark, sf_dir, "conversations"))


SQL = r"""
WITH ids AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base,
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
             lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))) % 9 AS h
  FROM (SELECT DISTINCT conv_id::BIGINT AS conv_id FROM conversations WHERE conv_id IS NOT NULL)),
turns AS (
  SELECT conv_id::BIGINT AS conv_id, sha256(strlen(role) || ':' || role || text) AS key, strlen(text) AS size,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
rebuilt AS (
  SELECT i.conv_id, 0 AS part, t.pos, t.key, t.size FROM ids i JOIN turns t ON t.conv_id = i.base AND t.pos <= i.h
  UNION ALL SELECT i.conv_id, 1, t.pos, t.key, t.size FROM ids i JOIN turns t ON t.conv_id = i.conv_id AND t.pos > i.h),
prefixes AS (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(key, '') OVER w AS path, size FROM rebuilt
  WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, '', 0 FROM ids),
ends AS (
  SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS sha
  FROM (SELECT conv_id, arg_max(path, depth) AS path FROM prefixes GROUP BY conv_id) GROUP BY path),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(size) AS saved,
         CASE WHEN depth > 0 THEN left(path, (64 * (depth - 1))::BIGINT) END AS above FROM prefixes GROUP BY path, depth),
children AS (SELECT above AS path, count(*) AS n FROM nodes WHERE above IS NOT NULL GROUP BY above),
own AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.path = n.path),
sums AS (
  SELECT p.path, sum(CASE WHEN o.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(o.saved) AS saved
  FROM own o JOIN prefixes p ON p.conv_id = o.conv_id AND p.depth <= o.depth GROUP BY p.path)
SELECT o.conv_id, o.depth::BIGINT AS depth, a.conv_id AS parent_conv_id, o.n_convs, o.n_children::BIGINT AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens,
       coalesce(e.sha, 'e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855') AS ends_sha256
FROM own o JOIN sums s ON s.path = o.path LEFT JOIN nodes a ON a.path = o.above LEFT JOIN ends e ON e.path = o.path
"""

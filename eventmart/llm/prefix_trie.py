"""Conversation prefix trie by adaptive radix trees over fixed-width turn ids.

A turn's id is the SHA-256 of its role and text, `WIDTH` big-endian bytes; a conversation's key is its turns' ids, so keys sort as
the trie is walked. Keys are dealt out by range over (key, conversation), and each task inserts its own into an adaptive radix
tree: nodes of 4, 16, 48 and 256 children that grow as they fill, with compressed paths. Bytes within an id
only branch; depths of whole ids are the nodes of the trie, also those inside a compressed path.

Only the prefixes of a task's first and of its last key can have members in other tasks. All other nodes are
finished where they are; those two spines leave as one row a task and are merged along one stack, in key order (one row
per range is all that the merging task sees). What hangs on a spine learns its parent's name by a join on (task, spine, depth).

A node's members that end there are hashed in order of their ids. Where they lie in several tasks, as those of a key that a third of all
conversations share, each task joins its own ids to a text and one stream hashes the texts in order.

Edge cases: turns are ordered by turn (null first), role, then the id of role and text; null role or text is empty; rows
without a conversation id are left out; repeated rows are turns of their own; a conversation without turns is a member of the root
alone; an empty table has no root; other columns are not read. A conversation's key must fit in a row: 2^31 bytes, 67 million turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.text import keep_columns
from eventmart.session import stage

WIDTH = 32
#: Bytes of keys that a task builds its tree from.
TASK_BYTES = 32 << 20
#: Rows of a result batch.
BATCH = 1 << 14

NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"


class Leaf:
    """What ends at a key: its conversations in order; `first` and `last` are how many turns it shares with the task's outer keys."""

    __slots__ = ("convs", "sizes", "first", "last")

    def __init__(self, convs: list[int], sizes: list[int]):
        self.convs, self.sizes, self.first, self.last = convs, sizes, -1, -1


class Node:
    """A node of a radix tree: a compressed path, an optional leaf and children in one of four layouts.

    4 and 16: sorted bytes beside the children. 48: a table of 256 slots into a list of children. 256: the children by byte.
    """

    __slots__ = ("path", "leaf", "layout", "keys", "children")

    def __init__(self, path: bytes, leaf: Leaf | None = None):
        self.path, self.leaf = path, leaf
        self.layout, self.keys, self.children = 4, bytearray(), []

    def child(self, byte: int) -> Node | None:
        if self.layout <= 16:
            at = self.keys.find(byte)
            return self.children[at] if at >= 0 else None
        if self.layout == 48:
            slot = self.keys[byte]
            return self.children[slot - 1] if slot else None
        return self.children[byte]

    def put(self, byte: int, child: Node) -> None:
        """Set the child of a byte; a full layout grows to the next."""
        if self.layout <= 16:
            at = self.keys.find(byte)
            if at >= 0:
                self.children[at] = child
                return
            if len(self.keys) == self.layout:
                self._grow()
                self.put(byte, child)
                return
            at = sum(k < byte for k in self.keys)
            self.keys.insert(at, byte)
            self.children.insert(at, child)
        elif self.layout == 48:
            slot = self.keys[byte]
            if slot:
                self.children[slot - 1] = child
            elif len(self.children) == 48:
                self._grow()
                self.children[byte] = child
            else:
                self.children.append(child)
                self.keys[byte] = len(self.children)
        else:
            self.children[byte] = child

    def _grow(self) -> None:
        if self.layout == 4:
            self.layout = 16
        elif self.layout == 16:
            table = bytearray(256)
            for slot, byte in enumerate(self.keys, 1):
                table[byte] = slot
            self.layout, self.keys = 48, table
        else:
            by_byte: list[Node | None] = [None] * 256
            for byte in range(256):
                if self.keys[byte]:
                    by_byte[byte] = self.children[self.keys[byte] - 1]
            self.layout, self.keys, self.children = 256, bytearray(), by_byte

    def in_order(self) -> list[Node]:
        """The children by byte."""
        if self.layout <= 16:
            return list(self.children)
        if self.layout == 48:
            return [self.children[s - 1] for s in self.keys if s]
        return [c for c in self.children if c is not None]


def shared_bytes(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class RadixTree:
    def __init__(self):
        self.root = Node(b"")

    def insert(self, key: bytes, leaf: Leaf) -> None:
        """Add a key that is not there yet."""
        node, parent, at = self.root, None, 0
        while True:
            same = shared_bytes(node.path, key[at : at + len(node.path)])
            if same < len(node.path):
                upper = Node(node.path[:same])
                below = node.path[same]
                node.path = node.path[same + 1 :]
                upper.put(below, node)
                if parent is None:
                    self.root = upper
                else:
                    parent.put(key[at - 1], upper)
                node = upper
            at += same
            if at == len(key):
                node.leaf = leaf
                return
            child = node.child(key[at])
            if child is None:
                node.put(key[at], Node(key[at + 1 :], leaf))
                return
            node, parent, at = child, node, at + 1


class Spine:
    """Partial nodes along an outer key, from depth `start` on."""

    def __init__(self, key: bytes, start: int):
        self.key, self.start = key, start
        self.nodes: dict[int, dict] = {}


class Walked:
    """The turn-aligned nodes of a radix tree: finished rows, and the two spines."""

    def __init__(self, tree: RadixTree, first: bytes, last: bytes, width: int):
        self.width = width
        self.rows: list[list] = []
        self.left = Spine(first, 0)
        self.right = Spine(last, shared_bytes(first, last) // width + 1)
        self._walk(tree.root)

    def _walk(self, root: Node) -> None:
        # Children before parents, without recursion: long conversations make deep trees.
        todo, order = [(root, len(root.path), -1)], []
        while todo:
            node, end, above = todo.pop()
            order.append((node, end, above))
            for child in node.in_order():
                todo.append((child, end + 1 + len(child.path), end))
        done: dict[int, tuple] = {}
        for node, end, above in reversed(order):
            n, least, kids, leaves, saved, pending, sample = 0, None, 0, 0, 0, [], node.leaf
            convs = []
            if node.leaf:
                convs = node.leaf.convs
                n, least = len(convs), convs[0]
            for child in node.in_order():
                m, low, k, x, s, rows, leaf = done.pop(id(child))
                n, kids, leaves, saved = n + m, kids + k, leaves + x, saved + s
                least = low if least is None else min(least, low)
                pending = rows if not pending else pending + rows if rows else pending
                sample = sample or leaf
            # Turn-aligned depths within this node's stretch of bytes, the deepest first.
            top = above // self.width if above >= 0 else -1
            for depth in range(end // self.width, top, -1):
                size = sample.sizes[depth - 1] if depth else 0
                ends = convs if depth * self.width == end and node.leaf else []
                if depth <= max(sample.first, sample.last):
                    spine, side = (self.left, 0) if depth <= sample.first else (self.right, 1)
                    for row in pending:
                        row[-2:] = [side, depth]
                    spine.nodes[depth] = {"n": n, "least": least, "kids": kids, "leaves": leaves, "saved": saved, "size": size, "ends": ends}
                    kids, leaves, saved, pending = 0, 0, 0, []
                    continue
                for row in pending:
                    row[2] = least
                leaves, saved = leaves if kids else 1, saved + (n - 1) * size
                digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
                row = [least, depth, None, n, kids, leaves, saved, digest, None, None]
                self.rows.append(row)
                kids, pending = 1, [row]
            done[id(node)] = (n, least, kids, leaves, saved, pending, sample)


PARTIAL = pa.struct([(k, pa.int64()) for k in ("n", "least", "kids", "leaves", "saved", "size")])
TASK_SCHEMA = (
    NODE + ", ends_sha256 string, side int, spine_depth bigint, part bigint, "
    "first binary, last binary, start bigint, left array<struct<n: bigint, least: bigint, kids: bigint, leaves: bigint, saved: bigint, size: bigint>>, "
    "right array<struct<n: bigint, least: bigint, kids: bigint, leaves: bigint, saved: bigint, size: bigint>>, chunk binary, chunk_at bigint"
)
TASK_TYPES = [
    *[(c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")],
    ("ends_sha256", pa.string()), ("side", pa.int32()), ("spine_depth", pa.int64()), ("part", pa.int64()), ("first", pa.binary()),
    ("last", pa.binary()), ("start", pa.int64()), ("left", pa.list_(PARTIAL)), ("right", pa.list_(PARTIAL)), ("chunk", pa.binary()), ("chunk_at", pa.int64()),
]


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, pa.schema(TASK_TYPES))


def _trees(width: int):
    """Finished nodes, then the spines and what ends on them, of a partition sorted by (key, conversation)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaves: list[tuple[bytes, Leaf]] = []
        for batch in batches:
            for key, conv, sizes in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if leaves and leaves[-1][0] == key:
                    leaves[-1][1].convs.append(conv)
                else:
                    leaves.append((key, Leaf([conv], sizes)))
        if not leaves:
            return
        first, last = leaves[0][0], leaves[-1][0]
        tree = RadixTree()
        for key, leaf in leaves:
            leaf.first, leaf.last = shared_bytes(first, key) // width, shared_bytes(last, key) // width
            tree.insert(key, leaf)
        part = leaves[0][1].convs[0]
        done = Walked(tree, first, last, width)
        names = [c for c, _ in TASK_TYPES[:10]]
        for at in range(0, len(done.rows), BATCH):
            yield _batch([dict(zip(names, r), part=part) for r in done.rows[at : at + BATCH]])
        told = lambda spine: [{k: v for k, v in spine.nodes[d].items() if k != "ends"} for d in sorted(spine.nodes)]
        yield _batch([{"part": part, "first": first, "last": last, "start": done.right.start, "left": told(done.left), "right": told(done.right)}])
        for side, spine in enumerate((done.left, done.right)):
            for depth, node in spine.nodes.items():
                if node["ends"]:
                    text = ",".join(map(str, node["ends"])).encode()
                    yield _batch([{"part": part, "side": side, "spine_depth": depth, "chunk": text, "chunk_at": node["ends"][0]}])

    return run


MERGED_SCHEMA = NODE + ", refs array<struct<part: bigint, side: int, spine_depth: bigint>>"
REF = pa.struct([("part", pa.int64()), ("side", pa.int32()), ("spine_depth", pa.int64())])
MERGED_TYPES = [*TASK_TYPES[:7], ("refs", pa.list_(REF))]


def _merged(width: int):
    """The spines of all tasks, in key order, along one stack of open nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[dict] = []
        out: list[dict] = []
        path = b""

        def close() -> None:
            x = stack.pop()
            leaves, saved = x["leaves"] if x["kids"] else 1, x["saved"] + (x["n"] - 1) * x["size"]
            row = {"conv_id": x["least"], "depth": len(stack), "parent_conv_id": None, "n_convs": x["n"], "n_children": x["kids"]}
            out.append(row | {"n_leaves": leaves, "saved_tokens": saved, "refs": x["refs"]})
            for child in x["below"]:
                child["parent_conv_id"] = x["least"]
            if stack:
                up = stack[-1]
                up["kids"], up["leaves"], up["saved"] = up["kids"] + 1, up["leaves"] + leaves, up["saved"] + saved
                up["below"].append(out[-1])

        def follow(key: bytes, nodes: list[dict], start: int, part: int, side: int) -> None:
            nonlocal path
            same = shared_bytes(path, key) // width
            while len(stack) > same + 1:
                close()
            path = key
            for depth, node in enumerate(nodes, start):
                ref = {"part": part, "side": side, "spine_depth": depth}
                if depth < len(stack):
                    held = stack[depth]
                    for k in ("n", "kids", "leaves", "saved"):
                        held[k] += node[k]
                    held["least"] = min(held["least"], node["least"])
                    held["refs"].append(ref)
                else:
                    stack.append(node | {"refs": [ref], "below": []})

        for batch in batches:
            for row in batch.to_pylist():
                follow(row["first"], row["left"], 0, row["part"], 0)
                follow(row["last"], row["right"], row["start"], row["part"], 1)
        while stack:
            close()
        for at in range(0, len(out), BATCH):
            yield pa.RecordBatch.from_pylist(out[at : at + BATCH], pa.schema(MERGED_TYPES))

    return run


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the chunks of each (conv_id, depth), which come sorted; one chunk is held at a time."""
    now, held = None, None
    for batch in batches:
        rows: list[tuple] = []
        for i in range(batch.num_rows):
            key = (batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
            if key == now:
                held.update(b",")
            else:
                if now:
                    rows.append((*now, held.hexdigest()))
                now, held = key, hashlib.sha256()
            held.update(batch.column(2)[i].as_py())
        yield _digests(rows)
    if now:
        yield _digests([(*now, held.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string())
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 3, kinds)], ["conv_id", "depth", "sha"])


def turn_lists(conversations: DataFrame) -> DataFrame:
    """`conv_id, turns`: each conversation's turns in order, as (id in hex, code points of the text)."""
    df = keep_columns(conversations, ["conv_id", "turn", "role", "text"]).where("conv_id is not null")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    told = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    turn = F.struct("turn", role.alias("role"), told.alias("id"), F.length(text).cast("long").alias("size"))
    lists = df.select(F.col("conv_id").cast("long"), turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return lists.select("conv_id", F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["size"].alias("size"))).alias("turns"))


def key_columns(turns: Column) -> list[Column]:
    ids = F.array_join(F.transform(turns, lambda t: t["id"]), "")
    return [F.unhex(ids).alias("key"), F.transform(turns, lambda t: t["size"]).alias("sizes")]


def nodes(lists: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """The trie of `conv_id, turns`, one row a conversation, as `turn_lists` gives them.

    Per node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    keys = stage(lists.select("conv_id", *key_columns(F.col("turns"))))
    size = keys.agg(F.sum(F.length("key") + 64)).first()[0] or 0
    ranged = keys.select("key", "conv_id", "sizes").repartitionByRange(max(1, -(-size // task_bytes)), "key", "conv_id")
    built = stage(ranged.sortWithinPartitions("key", "conv_id").mapInArrow(_trees(WIDTH), TASK_SCHEMA))
    spines = built.where("first is not null").select("first", "last", "start", "left", "right", "part")
    merged = stage(spines.coalesce(1).sortWithinPartitions("first", "last", "part").mapInArrow(_merged(WIDTH), MERGED_SCHEMA))
    named = merged.select(F.col("conv_id").alias("name"), F.col("depth").alias("at"), F.explode("refs").alias("ref"))
    named = named.select("name", "at", "ref.part", "ref.side", "ref.spine_depth")
    hung = ["part", "side", "spine_depth"]
    chunks = built.where("chunk is not null").select(*hung, "chunk", "chunk_at").join(named, hung)
    chunks = chunks.select(F.col("name").alias("conv_id"), F.col("at").alias("depth"), "chunk", "chunk_at")
    chunks = chunks.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "chunk_at").drop("chunk_at")
    digests = chunks.mapInArrow(_hashed, "conv_id bigint, depth bigint, sha string")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    outer = merged.join(digests, ["conv_id", "depth"], "left")
    outer = outer.select(*columns, F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
    inner = built.where("conv_id is not null").join(named, hung, "left")
    inner = inner.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "name")).select(*columns, "ends_sha256")
    return inner.unionByName(outer)


SHARED, GROUP = 6, 100


def shared_openings(lists: DataFrame) -> DataFrame:
    """Conversations that open as their group's first one does.

    The first h turns of conversation c - c % 100, then c's own after its first h; h is the unsigned crc32 of c in decimal, modulo 6.
    """
    lists = stage(lists)
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(SHARED)).cast("int")
    own = lists.select("conv_id", "turns", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"))
    heads = lists.where(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, SHARED - 1).alias("head"))
    opening = F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), F.col("h"))).otherwise(F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return own.join(heads, "base", "left").select("conv_id", F.concat(opening, rest).alias("turns"))

"""MinHash near-dedup over an LSH forest, with links confirmed on full sets.

A document's set holds its distinct three-word shingles; documents link at a Jaccard similarity of `LEAST` percent. Equal sets
are one node, whatever their count.

Forest: the signature has `SIZE` minimum hashes. Each tree is an order of the nodes by some of its values, and nodes
whose longest common prefix in a tree reaches the depth of their region are candidates. The depth adapts: 3 values (21 trees
of disjoint values) where at most `BLOCK` nodes share them; nodes of a denser region in any tree enter
the next orders, of 6 values (64 trees), and there a region of any size is compared whole, in tiles of two blocks. At similarity 0.85 a pair
misses all regions with a probability of about 2e-9 in the first orders and 5e-6 in the second.

Candidates are compared on one byte of each value: under `AGREE` equal ones (at 0.85 a chance of 1e-8) or with sizes too far apart they cannot link. A tile
returns a spanning forest of what is left, so its pairs never leave it, and star contraction makes families of it.

Confirmation: the full set of a family's node travels once, to its family or, where that is large, to one of its blocks. A
block decides all its pairs on the full sets but those that already hang together. If a family has several blocks,
candidates of unlike blocks that do not hang together yet are confirmed pair by pair, first the likeliest of any two parts
and then all that are left, so no link is lost to the cut.

Sets are compared as XXH64-mixed 64-bit hashes of their shingles; sizes are counted on word numbers, exactly.

Edge cases: null text and text without words have an empty set, size 0, and link with nothing; fewer than three words are one
shingle; only A-Z are folded; a null id keeps its row and never names a component; rows that repeat an id are documents
of their own; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.simhash import components
from eventmart.llm.text import keep_columns
from eventmart.session import stage

LEAST = 85
SHINGLE = 3
SIZE = 64
AGREE = 36
#: Nodes of a region that are compared at once; nodes of a family that are, and their shingles.
BLOCK = 2048
FAMILY = 8192
BLOCK_SHINGLES = 4 << 20
#: Shingles whose minimum hashes are computed at a time.
STRIDE = 1 << 11

_rng = np.random.default_rng(42)
ODD = _rng.integers(0, 1 << 63, SIZE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _rng.integers(0, 1 << 63, SIZE, dtype=np.uint64) * np.uint64(2) + _rng.integers(0, 2, SIZE, dtype=np.uint64)
FOREST = (
    np.arange(SIZE // 3 * 3).reshape(-1, 3),
    np.array([_rng.choice(SIZE, 6, replace=False) for _ in range(64)]),
)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


class Shingles:
    """Sets of shingle hashes; remembers word hashes within a bounded number of words."""

    MOST = 1 << 18

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> tuple[int, np.ndarray]:
        """Number of distinct shingles, and their distinct hashes in order."""
        from xxhash import xxh64_intdigest

        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return 0, np.empty(0, np.uint64)
        if len(words) < SHINGLE:
            return 1, mixed(np.array([xxh64_intdigest(b" ".join(words), 1)], np.uint64))
        known = self.known
        if len(known) > self.MOST:
            known.clear()
        hashes = np.empty(len(words), np.uint64)
        for i, w in enumerate(words):
            h = known.get(w)
            if h is None:
                h = known[w] = xxh64_intdigest(w, 0)
            hashes[i] = h
        _, ids = np.unique(hashes, return_inverse=True)
        n = int(ids.max()) + 1
        a, b, c = ids[:-2], ids[1:-1], ids[2:]
        if n < 1 << 21:
            _, first = np.unique((a.astype(np.uint64) * np.uint64(n) + b.astype(np.uint64)) * np.uint64(n) + c.astype(np.uint64), return_index=True)
        else:
            _, first = np.unique(np.stack((a, b, c)), axis=1, return_index=True)
        a, b, c = hashes[first], hashes[first + 1], hashes[first + 2]
        own = mixed(mixed(mixed(a) + b) + c)
        return len(first), np.unique(own)


def signature(own: np.ndarray) -> np.ndarray:
    """`SIZE` minimum hashes of 32 bits."""
    best = np.full(SIZE, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(own), STRIDE):
        part = own[at : at + STRIDE]
        for i in range(SIZE):
            low = int((part * ODD[i] + ADD[i]).min()) >> 32
            if low < best[i]:
                best[i] = low
    return best


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from xxhash import xxh3_128_digest

    shingles = Shingles()
    for batch in batches:
        sizes, marks, signatures = [], [], []
        for text in batch.column(1):
            n, own = shingles(text.as_py())
            sizes.append(n)
            marks.append(xxh3_128_digest(own.tobytes()) if n else None)
            signatures.append(signature(own).tobytes() if n else None)
        columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(marks, pa.binary()), pa.array(signatures, pa.binary())]
        yield pa.record_batch(columns, ["doc_id", "n_shingles", "mark", "signature"])


def _matrix(column: pa.Array, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _regions(level: int):
    """A row (region, node) for each tree; nodes of a region share the tree's values."""
    trees = FOREST[level]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = _matrix(batch.column(1), np.uint32, SIZE).astype(np.uint64)
            out = np.empty((len(values), len(trees)), np.uint64)
            for t, places in enumerate(trees):
                h = np.full(len(values), level * 1000 + t + 1, np.uint64)
                for p in places:
                    h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + values[:, p])
                out[:, t] = h
            node = np.repeat(batch.column(0).to_numpy(), len(trees))
            yield pa.record_batch([pa.array(out.ravel().view(np.int64)), pa.array(node)], ["region", "node"])

    return run


def grouped(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.Table]:
    """The rows of each group, where a partition is sorted by its first `n_keys` integer columns."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(i).to_numpy() for i in range(n_keys)]
        cuts = (np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1).tolist()
        if rest and any(rest[-1].column(i)[-1].as_py() != batch.column(i)[0].as_py() for i in range(n_keys)):
            yield pa.Table.from_batches(rest)
            rest = []
        for a, b in zip([0, *cuts], cuts):
            yield pa.Table.from_batches([*rest, batch.slice(a, b - a)])
            rest = []
        rest.append(batch.slice(cuts[-1] if cuts else 0))
    if rest:
        yield pa.Table.from_batches(rest)


def may_link(sizes: np.ndarray, marks: np.ndarray, i: int) -> np.ndarray:
    """Whether node i and each later one can reach the similarity, by sizes and signature bytes."""
    small, large = np.minimum(sizes[i], sizes[i + 1 :]), np.maximum(sizes[i], sizes[i + 1 :])
    out = 100 * small >= LEAST * large
    at = np.flatnonzero(out)
    out[at] = (marks[i + 1 + at] == marks[i]).sum(axis=1) >= AGREE
    return out


def _columns(table: pa.Table, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes, sizes and signature bytes, from column `at` on."""
    return table.column(at).to_numpy(), table.column(at + 1).to_numpy(), _matrix(table.column(at + 2), np.uint8, SIZE)


def _edges(left: list, right: list) -> pa.RecordBatch:
    return pa.record_batch([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["u", "v"])


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges that span the candidates of each tile (region, tile, node, size, bytes): from a part's smallest node to the others."""
    left: list[int] = []
    right: list[int] = []
    for table in grouped(batches, 2):
        if table.num_rows < 2:
            continue
        node, sizes, marks = _columns(table, 2)
        label = np.arange(len(node))
        for i in range(len(node) - 1):
            hits = i + 1 + np.flatnonzero(may_link(sizes, marks, i))
            parts = np.unique(label[hits])
            if len(parts) and (parts != label[i]).any():
                label[np.isin(label, parts) | (label == label[i])] = min(parts[0], label[i])
        far = np.flatnonzero(label != np.arange(len(node)))
        left += node[label[far]].tolist()
        right += node[far].tolist()
        if len(left) >= 1 << 15:
            yield _edges(left, right)
            left, right = [], []
    yield _edges(left, right)


def _cross_pairs(one_a_part: bool):
    """Candidates (region, tile, node, size, bytes, family, block, root) of one family in unlike blocks that do not hang together.

    With `one_a_part` only the likeliest of each two parts that meet in a tile.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, 2):
            if table.num_rows < 2:
                continue
            node, sizes, marks = _columns(table, 2)
            family, block, root = (table.column(i).to_numpy() for i in (5, 6, 7))
            best: dict[tuple[int, int], tuple[int, int, int]] = {}
            for i in range(len(node) - 1):
                hits = i + 1 + np.flatnonzero(may_link(sizes, marks, i))
                hits = hits[(family[hits] == family[i]) & (block[hits] != block[i]) & (root[hits] != root[i])]
                if not len(hits):
                    continue
                if not one_a_part:
                    yield _edges(np.minimum(node[i], node[hits]), np.maximum(node[i], node[hits]))
                    continue
                equal = (marks[hits] == marks[i]).sum(axis=1)
                for j in np.argsort(-equal, kind="stable").tolist():
                    parts = (min(root[i], root[hits[j]]), max(root[i], root[hits[j]]))
                    if parts not in best or best[parts][0] < equal[j]:
                        best[parts] = (int(equal[j]), min(node[i], node[hits[j]]), max(node[i], node[hits[j]]))
            if best:
                yield _edges([x[1] for x in best.values()], [x[2] for x in best.values()])

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The full set of each row (.., text, mark) whose text has that mark."""
    from xxhash import xxh3_128_digest

    shingles = Shingles()
    for batch in batches:
        n = batch.num_columns
        kept, sets = [], []
        for i, (text, mark) in enumerate(zip(batch.column(n - 2), batch.column(n - 1))):
            _, own = shingles(text.as_py())
            if xxh3_128_digest(own.tobytes()) == mark.as_py():
                kept.append(i)
                sets.append(own.tobytes())
        at = pa.array(kept, pa.int64())
        names = [*batch.schema.names[: n - 2], "held"]
        yield pa.record_batch([*[c.take(at) for c in batch.columns[: n - 2]], pa.array(sets, pa.binary())], names)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two ordered sets reach the similarity."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int(np.count_nonzero(b[at] == a))
    return 100 * both >= LEAST * (len(a) + len(b) - both)


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges from each part's first node to its others, for blocks (family, block, node, size, bytes, set)."""
    left: list[int] = []
    right: list[int] = []
    for table in grouped(batches, 2):
        # A node can come from several rows with its text.
        _, once = np.unique(table.column(2).to_numpy(), return_index=True)
        table = table.take(pa.array(once))
        node, sizes, marks = _columns(table, 2)
        sets = [np.frombuffer(x, np.uint64) for x in table.column(5).to_pylist()]
        label = np.arange(len(node))
        for i in range(len(node) - 1):
            for j in (i + 1 + np.flatnonzero(may_link(sizes, marks, i))).tolist():
                if label[j] != label[i] and linked(sets[i], sets[j]):
                    low, high = sorted((label[i], label[j]))
                    label[label == high] = low
        far = np.flatnonzero(label != np.arange(len(node)))
        left += node[label[far]].tolist()
        right += node[far].tolist()
        if len(left) >= 1 << 15:
            yield _edges(left, right)
            left, right = [], []
    yield _edges(left, right)


def _confirmed_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [linked(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) for a, b in zip(*(batch.column(i).to_pylist() for i in (2, 3)))]
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def candidate_tiles(nodes: DataFrame) -> DataFrame:
    """`region, tile, node, n_shingles, bytes` of all nodes that share a region at its depth, by region and tile."""
    wanted, found = nodes, None
    for level in range(len(FOREST)):
        rows = wanted.select("node", "signature").mapInArrow(_regions(level), "region bigint, node bigint")
        met = rows.join(rows.groupBy("region").agg(F.count("*").alias("n")).where("n > 1"), "region")
        if level + 1 < len(FOREST):
            met = stage(met)
            dense = met.where(F.col("n") > BLOCK).select("node").distinct()
            wanted = nodes.join(dense, "node", "left_semi")
            met = met.where(F.col("n") <= BLOCK)
        found = met if found is None else found.unionByName(met)
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    found = found.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # Tile (i, j) with i < j holds blocks i and j; a region of one block is tile 0.
    tiles = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(
        F.transform(
            F.array_remove(F.sequence(F.lit(0), F.col("blocks") - 1), F.col("own")),
            lambda x: F.least(x, F.col("own")) * F.col("blocks") + F.greatest(x, F.col("own")),
        )
    )
    found = found.select("region", F.explode(tiles).alias("tile"), "node")
    return found.join(nodes.select("node", "n_shingles", "bytes"), "node").select("region", "tile", "node", "n_shingles", "bytes")


def tiled(rows: DataFrame) -> DataFrame:
    return rows.repartition("region", "tile").sortWithinPartitions("region", "tile", "node")


def _short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signatures (last column) with their lowest bytes beside them."""
    for batch in batches:
        n = batch.num_columns
        low = (_matrix(batch.column(n - 1), np.uint32, SIZE) & np.uint32(255)).astype(np.uint8)
        yield pa.record_batch([*batch.columns, pa.array([x.tobytes() for x in low], pa.binary())], [*batch.schema.names, "bytes"])


def thinned(edges: DataFrame) -> DataFrame:
    """Fewer edges `u < v` with the same components.

    A node hangs on the smallest of its u, and so do its other u; these coincide for most nodes of a cluster. A node has as
    many u as tiles, so the sets are small.
    """
    met = edges.groupBy("v").agg(F.min("u").alias("low"), F.collect_set("u").alias("us"))
    other = met.select(F.col("low").alias("u"), F.explode("us").alias("v")).where("u != v").distinct()
    return met.select(F.col("low").alias("u"), "v").unionByName(other)


def links(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Confirmed edges `u, v` that span the links among `nodes` (node, id, n_shingles, mark, signature, bytes)."""
    tiles = stage(candidate_tiles(nodes))
    family = components(thinned(tiled(tiles).mapInArrow(_forests, "u bigint, v bigint")))
    family = stage(family.select("node", F.col("root").alias("family")).unionByName(family.select("root", "root").distinct().toDF("node", "family")))
    own = family.join(nodes, "node")
    size = own.groupBy("family").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("n") / F.lit(FAMILY)), F.ceil(F.col("shingles") / F.lit(BLOCK_SHINGLES)))
    own = own.join(size.select("family", blocks.alias("blocks")), "family")
    own = stage(own.select("family", F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")).alias("block"), "blocks", "node", "id", "n_shingles", "bytes", "mark"))
    texts = docs.select(docs["doc_id"].alias("id"), docs["text"].cast("string").alias("text"))
    rows = texts.join(own, "id").select("family", "block", "node", "n_shingles", "bytes", "text", "mark")
    schema = "family bigint, block bigint, node bigint, n_shingles bigint, bytes binary, held binary"
    sets = rows.mapInArrow(_sets, schema)
    apart = own.where("blocks > 1")
    if apart.isEmpty():
        edges = sets.repartition("family", "block").sortWithinPartitions("family", "block", "node")
        return edges.mapInArrow(_confirmed, "u bigint, v bigint")
    sets = stage(sets)
    edges = sets.repartition("family", "block").sortWithinPartitions("family", "block", "node")
    edges = stage(edges.mapInArrow(_confirmed, "u bigint, v bigint"))
    # What the cut into blocks keeps apart: candidates of unlike blocks and parts, confirmed pair by pair. The likeliest pair of any
    # two parts goes first, so that a large group of copies hangs together before the rest is looked at.
    full = stage(sets.select("node", "held").dropDuplicates(["node"]))
    for one_a_part in (True, False):
        place = apart.select("node", "family", "block").join(components(edges), "node", "left").withColumn("root", F.coalesce("root", "node"))
        pairs = tiled(tiles.join(place, "node").select(*tiles.columns, "family", "block", "root"))
        pairs = pairs.mapInArrow(_cross_pairs(one_a_part), "u bigint, v bigint").distinct()
        both = pairs.join(full.toDF("u", "a"), "u").join(full.toDF("v", "b"), "v").select("u", "v", "a", "b")
        edges = stage(edges.unionByName(both.mapInArrow(_confirmed_pairs, "u bigint, v bigint")))
    return edges


def classes(df: DataFrame) -> DataFrame:
    """`doc_id, n_shingles, component_id, kept` of every document."""
    id_type = df.schema["doc_id"].dataType.simpleString()
    prints = keep_columns(df, ["doc_id", "text"]).mapInArrow(_prints, f"doc_id {id_type}, n_shingles bigint, mark binary, signature binary")
    prints = stage(prints)
    nodes = prints.where("mark is not null and doc_id is not null").groupBy("mark", "n_shingles", "signature").agg(F.min("doc_id").alias("id"))
    nodes = nodes.withColumn("node", F.monotonically_increasing_id()).select("node", "id", "n_shingles", "mark", "signature")
    schema = f"node bigint, id {id_type}, n_shingles bigint, mark binary, signature binary, bytes binary"
    nodes = stage(nodes.mapInArrow(_short, schema))
    roots = stage(components(links(df, nodes)))
    named = nodes.select("node", "id", "mark").join(roots, "node", "left").select("id", "mark", F.coalesce("root", "node").alias("root"))
    named = stage(named)
    least = named.groupBy("root").agg(F.min("id").alias("component_id"))
    named = named.join(least, "root").select("mark", "component_id")
    out = prints.join(named, "mark", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))

"""SimHash near-dedup: bit-sliced Hamming comparison and distributed components.

Fingerprint: ASCII-lower-cased words, three-word shingles (repeats included), one XXH64
(seed 42) each, and for every bit the majority. Two fingerprints link at `radius` = 3 or
fewer differing bits.

Candidates: the 64 bits are cut into five bands; at three differing bits two bands at
least are equal, so equal fingerprints of one of the ten band pairs (25 or 26 bits) meet
in one bucket and no link is lost. Equal fingerprints are one node, whatever their count.

Comparison within a bucket is bit-sliced: 64 bit planes hold the block's fingerprints
vertically, each plane is XORed with one bit of a query, and carry-save counters of two
bits plus a sticky overflow add up 64 fingerprints per machine word; queries whose lanes
have all overflowed are abandoned. A bucket over `BLOCK` nodes is cut into blocks and
every pair of blocks is one task's tile. A tile returns a spanning forest of its links,
never its pairs, so a cluster of any density gives fewer edges than nodes per tile.

Components come from alternating large-star and small-star contraction, each round
staged in the shared folder; joins, not collected groups, carry the labels.

Edge cases: null text is empty; a text without words has fingerprint 0 and links like any
other; fewer than three words hash as one shingle; exact copies and repeated rows share a
node; a null id keeps its row and never names a component; other columns are not read;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.text import free_name, keep_columns
from eventmart.session import stage

RADIUS = 3
SHINGLE = 3
SEED = 42
BANDS = (13, 13, 13, 13, 12)
BLOCK = 2048
#: Comparisons for a task.
TASK_PAIRS = 1 << 23
#: Shingles turned into bits at a time.
STRIDE = 1 << 15


def fingerprint(text: str | None) -> int:
    """The fingerprint as a signed 64-bit number."""
    from xxhash import xxh64_digest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < SHINGLE:
        digests = [xxh64_digest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[: -SHINGLE])).tolist()
        digests = [xxh64_digest(joined[a:b], SEED) for a, b in zip(starts, (ends[SHINGLE - 1 :] - 1).tolist())]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(digests), STRIDE):
        raw = np.frombuffer(b"".join(digests[at : at + STRIDE]), np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(digests)).tobytes(), "big", signed=True)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [fingerprint(x.as_py()) for x in batch.column(1)]
        yield pa.record_batch([batch.column(0), pa.array(prints, pa.int64())], ["doc_id", "fp"])


def _marked_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [fingerprint(x.as_py()) for x in batch.column(1)]
        yield pa.record_batch([batch.column(0), batch.column(2), pa.array(prints, pa.int64())], ["doc_id", "mark", "fp"])


def fingerprints(df: DataFrame) -> DataFrame:
    """`doc_id` and `fp`, one row per document."""
    id_type = df.schema["doc_id"].dataType.simpleString()
    return keep_columns(df, ["doc_id", "text"]).mapInArrow(_fingerprints, f"doc_id {id_type}, fp bigint")


def near_forest(prints: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Index pairs that span the links among distinct fingerprints, by bit-sliced comparison."""
    n = len(prints)
    lanes = -(-n // 64)
    bits = np.unpackbits(prints.astype(">u8").view(np.uint8).reshape(n, 8), axis=1)
    padded = np.zeros((64, lanes * 64), np.uint8)
    padded[:, :n] = bits.T
    planes = np.packbits(padded, axis=1, bitorder="little").view("<u8")
    valid = np.packbits(np.arange(lanes * 64) < n, bitorder="little").view("<u8")
    every = np.uint64(0xFFFFFFFFFFFFFFFF)
    near = np.zeros((n, lanes), np.uint64)
    step = max(1, (1 << 16) // lanes)
    for begin in range(0, n, step):
        rows = np.arange(begin, min(n, begin + step))
        one, two, over = (np.zeros((len(rows), lanes), np.uint64) for _ in range(3))
        over |= ~valid
        for p in range(64):
            if p % 8 == 0 and p:
                # The query itself never overflows; a block is done once no other lane is left.
                open_lanes = np.bitwise_count(~over).sum(axis=1) > 1
                if not open_lanes.all():
                    rows, one, two, over = rows[open_lanes], one[open_lanes], two[open_lanes], over[open_lanes]
                if not len(rows):
                    break
            differs = planes[p][None, :] ^ np.where(bits[rows, p], every, np.uint64(0))[:, None]
            carry = one & differs
            one ^= differs
            more = two & carry
            two ^= carry
            over |= more
        if radius < 3:
            count_over = two & one if radius == 2 else two if radius == 1 else two | one
            over |= count_over
        near[rows] = ~over
    # Walk the link graph by rows of lanes; each node is opened once.
    found: list[tuple[int, int]] = []
    fresh = np.unpackbits(valid.view(np.uint8), bitorder="little").astype(bool)
    lonely = np.bitwise_count(near).sum(axis=1) <= 1
    for root in np.flatnonzero(~lonely):
        if not fresh[root]:
            continue
        fresh[root] = False
        todo = [int(root)]
        while todo:
            at = todo.pop()
            row = np.unpackbits(near[at].view(np.uint8), bitorder="little").astype(bool) & fresh
            nxt = np.flatnonzero(row).tolist()
            fresh[nxt] = False
            found.extend((at, x) for x in nxt)
            todo.extend(nxt)
    return found


def _tile_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of tiles; rows come sorted by (band pair, key, tile), a tile's rows in one partition."""
    held: list[pa.RecordBatch] = []

    def edges(table: pa.Table) -> pa.RecordBatch:
        keys = [table.column(i).to_numpy() for i in range(3)]
        fp, node = table.column(3).to_numpy(), table.column(4)
        new = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        left, right = [], []
        for a, b in zip([0, *new.tolist()], [*new.tolist(), len(fp)]):
            if b - a > 1:
                for x, y in near_forest(fp[a:b].view(np.uint64)):
                    left.append(a + x)
                    right.append(a + y)
        take = lambda at: node.take(pa.array(at, pa.int64())).combine_chunks()
        return pa.record_batch([take(left), take(right)], ["u", "v"])

    def last_key(batch):
        return tuple(batch.column(i)[-1].as_py() for i in range(3))

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) >= 1 << 15:
            # All but the last tile is complete.
            table = pa.Table.from_batches(held)
            end = last_key(batch)
            same = np.logical_and.reduce([table.column(i).to_numpy() == end[i] for i in range(3)])
            cut = int(np.argmax(same))
            if cut:
                yield edges(table.slice(0, cut))
                held = table.slice(cut).combine_chunks().to_batches()
    if held:
        yield edges(pa.Table.from_batches(held))


def link_edges(nodes: DataFrame) -> DataFrame:
    """Spanning links `u, v` among `nodes` (fp, node); fp distinct."""
    starts = [sum(BANDS[:i]) for i in range(len(BANDS))]
    bands = [
        F.shiftrightunsigned(F.col("fp"), 64 - s - w).bitwiseAND(F.lit((1 << w) - 1)) for s, w in zip(starts, BANDS)
    ]
    pairs = [(i, j) for i in range(len(BANDS)) for j in range(i + 1, len(BANDS))]
    keys = F.array(*[F.shiftleft(bands[i], BANDS[j]).bitwiseOR(bands[j]) for i, j in pairs])
    rows = nodes.select("fp", "node", F.posexplode(keys).alias("pair", "key"))
    # Buckets of one fingerprint have nothing to compare; large ones are cut into tiles.
    counted = stage(rows.groupBy("pair", "key").agg(F.count("*").alias("n")).where("n > 1"))
    # Tasks by the comparisons to make, which grow faster than the rows that Spark would go by.
    n = F.col("n").cast("double")
    work = counted.agg(F.sum(n * n)).first()[0] or 0
    tasks = int(work // TASK_PAIRS) + 1
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    met = rows.join(counted.withColumn("blocks", blocks), ["pair", "key"])
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    met = met.withColumn("own", own)
    # Tile (i, j) with i < j holds blocks i and j; a bucket of one block is tile 0.
    tiles = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(
        F.transform(
            F.array_remove(F.sequence(F.lit(0), F.col("blocks") - 1), F.col("own")),
            lambda x: F.least(x, F.col("own")) * F.col("blocks") + F.greatest(x, F.col("own")),
        )
    )
    met = met.select("pair", "key", F.explode(tiles).alias("tile"), "fp", "node")
    met = met.repartition(tasks, "pair", "key", "tile").sortWithinPartitions("pair", "key", "tile")
    kind = nodes.schema["node"].dataType.simpleString()
    return met.mapInArrow(_tile_edges, f"u {kind}, v {kind}").distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """`node, root`: for every node of a link, the smallest node it reaches; roots themselves left out.

    Star contraction on (u, v): the large star hangs a node's larger neighbours, the small
    star its smaller ones, on the smallest; rounds go on until nothing changes.
    """
    now = stage(edges.where("u != v"))
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        hung = down.join(low, "u")
        small = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        now = stage(small.where("u != v").distinct())
        last, mark = mark, _mark(now)
        if mark == last:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def classes(df: DataFrame) -> DataFrame:
    """`doc_id, fp, component_id` of every document."""
    prints = stage(fingerprints(df))
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("node")))
    roots = components(link_edges(nodes.where("node is not null")))
    named = nodes.join(roots, "node", "left").select("fp", F.coalesce("root", "node").alias("component_id"))
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(df: DataFrame) -> DataFrame:
    """One row of each class: of the smallest id, and of rows that repeat it that of the smallest hash over all columns.

    Rows that repeat an id with unlike texts are documents of their own, each in the class of its text, and so
    are equal rows, of which one stays. Rows without an id cannot be named, so they all stay and link nothing.
    Nothing hangs on the order of rows; an empty table gives none.
    """
    mark = free_name(df, "mark")
    rows = df.withColumn(mark, F.xxhash64(*[df[c] for c in df.columns]))
    kind = df.schema["doc_id"].dataType.simpleString()
    named = rows.where(rows["doc_id"].isNotNull()).select(rows["doc_id"], rows["text"], rows[mark].alias("mark"))
    prints = stage(named.mapInArrow(_marked_prints, f"doc_id {kind}, mark bigint, fp bigint"))
    nodes = prints.groupBy("fp").agg(F.min(F.struct("doc_id", "mark")).alias("least"))
    nodes = stage(nodes.withColumn("node", F.monotonically_increasing_id()))
    roots = components(link_edges(nodes.select("fp", "node")))
    parts = nodes.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("part")).agg(F.min("least").alias("least"))
    chosen = parts.select("least.doc_id", F.col("least.mark").alias(mark))
    kept = rows.join(chosen, ["doc_id", mark], "left_semi").dropDuplicates(["doc_id", mark])
    return kept.select(*df.columns).unionByName(df.where(df["doc_id"].isNull()))

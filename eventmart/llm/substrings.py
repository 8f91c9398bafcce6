"""Exact removal of repeated byte strings by a hash-compared suffix sort around shared anchors.

A byte goes if it lies in a string of `LENGTH` bytes that starts anywhere else too. Sorting every suffix of a corpus is out
of reach, and not needed: a window keeps of its `GRAM`-byte grams the one with the smallest hash, its anchor, and equal windows
have equal anchors at equal places. So

1. anchors: one scan finds the anchors (about one for 77 bytes) by prefix polynomial hashes, with a hash of
   the gram and one of the `LENGTH - GRAM` bytes on either side, the context;
2. equal contexts: anchors are counted by (gram, context); of those met twice every window is repeated, and their
   number does not matter any more, so copies cost one row per task;
3. unlike contexts of one gram, at the edges of repeated passages, are compared: a second scan fetches one context
   of each kind, and the groups are suffix-sorted to both sides of the anchor. Comparisons find the common extension by binary
   search over prefix polynomial hashes (logarithmic in its length), the sort is a mergesort, and the neighbours' common
   extensions are verified byte by byte. Windows are repeated if they fall in one class to the left and one to the right;
4. what is covered is gathered per document and cut out of the text.

A group of more than `GROUP_MOST` unlike contexts is not sorted in one task: its windows are hashed
and counted by partial sums instead, with the same result.

Polynomial hashes are modulo 2^64 over strings of at most `2 * LENGTH` bytes. Equal grams and sorted windows are
verified on bytes; step 2 trusts two 64-bit hashes of equal windows. Documents are told apart by 128 bits, two hashes of id and
text that start from different seeds, so that unlike documents of 10^10 share a key with a probability below 1e-18.

Edge cases: null text is empty; texts under `LENGTH` bytes have nothing removed; a string that overlaps itself counts;
repeated rows are documents of their own and remove each other; a null id is passed on; very long
texts are hashed in segments; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.bits import build_filter, may_hold
from eventmart.llm.text import text_or_empty
from eventmart.session import stage

LENGTH = 200
GRAM = 48
SEGMENT = 1 << 16
GROUP_MOST = 50_000
#: Contexts sorted at a time.
BLOCK = 1 << 13

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _sliding(x: np.ndarray, width: int, least: bool) -> np.ndarray:
    """The minimum or maximum of every `width` neighbours, by doubling."""
    best, span = (np.minimum if least else np.maximum), 1
    while 2 * span <= width:
        x = best(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return best(x[:-rest], x[rest:]) if rest else x


class Hasher:
    """Anchors and context hashes of texts, for one window length."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        self.length, self.gram, self.side = length, gram, length - gram
        most = SEGMENT + 4 * length
        self.up, self.down = _powers(BASE, most + 1), _powers(INVERSE, most + 1)

    def anchors(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions of the anchors with the hashes of their grams and contexts, as signed numbers."""
        n = len(data)
        if n < self.length:
            return (np.empty(0, np.int64),) * 3
        parts = [self._segment(data, a, min(n, a + SEGMENT)) for a in range(0, n, SEGMENT)]
        return tuple(np.concatenate(x) for x in zip(*parts))

    def _segment(self, data: np.ndarray, begin: int, end: int):
        """The anchors in [begin, end); what they depend on lies within two lengths to either side."""
        n, gram, width = len(data), self.gram, self.length - self.gram + 1
        a, b = max(0, begin - 2 * self.length), min(n, end + 2 * self.length)
        part = data[a:b]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * self.up[: len(part)], out=sums[1:])
        grams = mixed((sums[gram:] - sums[:-gram]) * self.down[: len(part) - gram + 1])
        low = _sliding(grams, width, True)
        edge = np.zeros(width - 1, np.uint64)
        chosen = np.flatnonzero(_sliding(np.concatenate((edge, low, edge)), width, False) == grams)
        # Windows cut by the segment's margin are not windows of the text.
        at = chosen[(chosen + a >= begin) & (chosen + a < end)]
        left, right = np.minimum(self.side, at + a), np.minimum(self.side, n - gram - at - a)
        lo, hi = at - left, at + gram + right
        context = (sums[hi] - sums[lo]) * self.down[lo]
        shape = (left * (self.length + 1) + right + 1).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return at + a, grams[at].view(np.int64), mixed(mixed(context) + shape).view(np.int64)


def _bytes(text) -> bytes:
    return (text.as_py() or "").encode("utf-8", "surrogatepass")


#: The two halves of a row's key.
KEY = ["uid", "uid2"]


def row_key(df: DataFrame) -> list[Column]:
    """128 bits that rows with equal id and text share, and no others."""
    text = text_or_empty(df)
    return [F.xxhash64(df["doc_id"], text).alias("uid"), F.xxhash64(F.lit("second"), text, df["doc_id"]).alias("uid2")]


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher, names = Hasher(), [*KEY, "pos", "gram", "context"]
    for batch in batches:
        out, n = [], 0
        for *key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            at, gram, context = hasher.anchors(np.frombuffer(_bytes(text), np.uint8))
            out.append((*(np.full(len(at), k, np.int64) for k in key), at, gram, context))
            n += len(at)
            if n > 1 << 16:
                yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*out)], names)
                out, n = [], 0
        if out:
            yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*out)], names)


def _filtered(shared):
    """Anchors whose gram the filter lets through."""

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(may_hold(shared.value, batch.column(3).to_numpy().view(np.uint64))))

    return run


def _contexts(shared):
    """Of anchors whose gram the filter lets through: the context's bytes and how many stand before the anchor."""

    def run(batches):
        hasher = Hasher()
        for batch in batches:
            out: list[tuple] = []
            for text in batch.column(0):
                raw = _bytes(text)
                at, gram, context = hasher.anchors(np.frombuffer(raw, np.uint8))
                for i in np.flatnonzero(may_hold(shared.value, gram.view(np.uint64))).tolist():
                    p = int(at[i])
                    lo = max(0, p - hasher.side)
                    out.append((int(gram[i]), int(context[i]), p - lo, raw[lo : p + hasher.length]))
                if len(out) > 1 << 14:
                    yield _context_batch(out)
                    out = []
            if out:
                yield _context_batch(out)

    return run


def _context_batch(rows):
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["gram", "context", "before", "raw"])


class Strings:
    """Byte strings side by side, with the prefix polynomial hashes that their comparison uses."""

    def __init__(self, rows: list[bytes], width: int):
        self.lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        self.data = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), np.uint8).reshape(len(rows), width)
        self.prefix = np.zeros((len(rows), width + 1), np.uint64)
        for t in range(width):
            self.prefix[:, t + 1] = self.prefix[:, t] * np.uint64(BASE) + self.data[:, t] + np.uint64(1)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The length of the common prefix of each pair: binary search for the last equal prefix hash."""
        low, high = np.zeros(len(a), np.int64), np.minimum(self.lengths[a], self.lengths[b])
        while (low < high).any():
            mid = (low + high + 1) >> 1
            same = self.prefix[a, mid] == self.prefix[b, mid]
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def compare(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 of each pair; a string that ends comes first."""
        n = self.common(a, b)
        width = self.data.shape[1]
        next_a = np.where(n < self.lengths[a], self.data[a, np.minimum(n, width - 1)].astype(np.int64), -1)
        next_b = np.where(n < self.lengths[b], self.data[b, np.minimum(n, width - 1)].astype(np.int64), -1)
        return np.sign(next_a - next_b)

    def order(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Mergesort of the strings within their groups; `start` and `size` say each row's group."""
        order, run = np.arange(len(start)), 1
        while run < size.max(initial=0):
            at = np.flatnonzero(size > run)
            first, place = start[at], at - start[at]
            block = place // run
            other = first + (block ^ 1) * run
            end = np.minimum(other + run, first + size[at])
            met = other < end
            at, first, place, block, other, end = (x[met] for x in (at, first, place, block, other, end))
            low, high, later = other.copy(), end.copy(), (block & 1).astype(bool)
            active = np.flatnonzero(low < high)
            while len(active):
                mid = (low[active] + high[active]) >> 1
                c = self.compare(order[at[active]], order[mid])
                beyond = (c > 0) | (c == 0) & later[active]
                low[active] = np.where(beyond, mid + 1, low[active])
                high[active] = np.where(beyond, high[active], mid)
                active = active[low[active] < high[active]]
            to = first + (block & ~1) * run + place % run + low - other
            merged = order.copy()
            merged[to] = order[at]
            order, run = merged, 2 * run
        return order

    def extensions(self, order: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Common prefix of each string with the one before it in its group (-1: it is the first), verified on bytes."""
        out = np.full(len(order), -1, np.int64)
        at = np.flatnonzero(start[1:] == start[:-1]) + 1
        a, b = order[at - 1], order[at]
        found = self.common(a, b)
        most = np.minimum(self.lengths[a], self.lengths[b])
        same = (self.data[a] == self.data[b]) & (np.arange(self.data.shape[1]) < most[:, None])
        true = np.where(same.all(axis=1), self.data.shape[1], same.argmin(axis=1))
        if (found != true).any():
            raise ArithmeticError("two strings share a hash")
        out[at] = found
        return out


def _classes(order: np.ndarray, extension: np.ndarray, depth: int) -> np.ndarray:
    """A number for each string that strings with equal prefixes of `depth` bytes share."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(extension < depth)
    return out


def repeated_offsets(groups: np.ndarray, before: list[bytes], after: list[bytes], length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """For each context and each offset o up to `length - gram`: does the window that starts o bytes before the anchor recur?

    `groups` is sorted; `before` is what precedes the anchor, reversed, `after` the gram and what follows.
    """
    side = length - gram
    first = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))
    size = np.diff(np.append(first, len(groups)))
    start, size = np.repeat(first, size), np.repeat(size, size)
    left, right = Strings(before, side), Strings(after, length)
    try:
        sides = [(s, o := s.order(start, size), s.extensions(o, start)) for s in (left, right)]
    except ArithmeticError:
        # A collision of prefix hashes, met about never: sort the bytes themselves.
        sides = []
        for s in (left, right):
            rows = before if s is left else after
            o = np.array(sorted(range(len(groups)), key=lambda i: (start[i], rows[i])))
            s.prefix = None
            e = np.full(len(o), -1, np.int64)
            for i in range(1, len(o)):
                if start[i] == start[i - 1]:
                    x, y = rows[o[i - 1]], rows[o[i]]
                    e[i] = next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
            sides.append((s, o, e))
    (_, lo, le), (_, ro, re_) = sides
    out = np.zeros((len(groups), side + 1), bool)
    for o in range(side + 1):
        fits = np.flatnonzero((left.lengths >= o) & (right.lengths >= length - o))
        if len(fits) < 2:
            continue
        key = _classes(lo, le, o)[fits] * (len(groups) + 1) + _classes(ro, re_, length - o)[fits]
        by = np.argsort(key, kind="stable")
        same = key[by][1:] == key[by][:-1]
        out[fits[by], o] = np.concatenate((same, [False])) | np.concatenate(([False], same))
    return out


def _spans(found: np.ndarray, length: int) -> tuple[list[list[int]], list[list[int]]]:
    """Begins and ends, from the anchor, of the runs of repeated windows of each context."""
    padded = np.zeros((len(found), found.shape[1] + 2), np.int8)
    padded[:, 1:-1] = found
    step = np.diff(padded, axis=1)
    begins: list[list[int]] = [[] for _ in range(len(found))]
    ends: list[list[int]] = [[] for _ in range(len(found))]
    for (row, first), (_, past) in zip(np.argwhere(step == 1).tolist(), np.argwhere(step == -1).tolist()):
        begins[row].append(-(past - 1))
        ends[row].append(length - first)
    return begins, ends


SPAN_TYPES = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))


def _compare_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (gram, context), a gram's rows in one partition, to the spans of each context."""
    rows: list[tuple] = []

    def judged(rows):
        side = LENGTH - GRAM
        groups = np.array([r[0] for r in rows], np.int64)
        found = repeated_offsets(groups, [r[3][: r[2]][::-1][:side] for r in rows], [r[3][r[2] :] for r in rows])
        hit = np.flatnonzero(found.any(axis=1))
        begins, ends = _spans(found[hit], LENGTH)
        columns = ([rows[i][0] for i in hit], [rows[i][1] for i in hit], begins, ends)
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, SPAN_TYPES)], ["gram", "context", "begins", "ends"])

    for batch in batches:
        rows += zip(*(batch.column(i).to_pylist() for i in range(4)))
        if len(rows) >= BLOCK:
            last = rows[-1][0]
            cut = next(i for i in range(len(rows) - 1, -2, -1) if i < 0 or rows[i][0] != last) + 1
            if cut:
                yield judged(rows[:cut])
                rows = rows[cut:]
    if rows:
        yield judged(rows)


def _hash_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of a context with the digest of its bytes."""
    side = LENGTH - GRAM
    for batch in batches:
        for gram, context, before, raw in zip(*(batch.column(i).to_pylist() for i in range(4))):
            offsets = [o for o in range(min(before, side) + 1) if before - o + LENGTH <= len(raw)]
            digests = [hashlib.blake2b(raw[before - o : before - o + LENGTH], digest_size=16).digest() for o in offsets]
            n = len(offsets)
            yield pa.record_batch(
                [pa.array([gram] * n, pa.int64()), pa.array([context] * n, pa.int64()), pa.array(offsets, pa.int32()), pa.array(digests, pa.binary())],
                ["gram", "context", "offset", "digest"],
            )


def _counted_spans(contexts: DataFrame) -> DataFrame:
    """The spans of very large groups, by counting window digests instead of sorting."""
    windows = contexts.mapInArrow(_hash_windows, "gram bigint, context bigint, offset int, digest binary")
    twice = windows.groupBy("gram", "offset", "digest").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    hits = windows.join(twice, ["gram", "offset", "digest"])
    return hits.groupBy("gram", "context").agg(
        F.collect_list(-F.col("offset")).alias("begins"), F.collect_list(F.lit(LENGTH) - F.col("offset")).alias("ends")
    )


def repeated_spans(df: DataFrame) -> DataFrame:
    """`uid, uid2, spans` of rows with something to remove: `spans` are (begin, end), in no order and overlapping.

    The first two are `row_key`. A span may reach past the text's ends, where it is to be cut.
    """
    texts = df.select(*row_key(df), text_or_empty(df).alias("text"))
    anchors = stage(texts.mapInArrow(_anchors, "uid bigint, uid2 bigint, pos bigint, gram bigint, context bigint"))
    grams = anchors.groupBy("gram").agg(
        F.count("*").alias("n"), (F.min("context") < F.max("context")).alias("unlike")
    )
    grams = stage(grams.where("n > 1").select("gram", "unlike"))
    # Most grams are met once; their anchors go before anything else is shuffled.
    again, n = build_filter(grams.select(F.col("gram").alias("h")))
    anchors = anchors.mapInArrow(_filtered(again), anchors.schema)
    kinds = anchors.groupBy("gram", "context").agg(F.count("*").alias("n"))
    shared, n = build_filter(grams.where("unlike").select(F.col("gram").alias("h")))
    side = LENGTH - GRAM
    equal = kinds.where("n > 1").select(
        "gram", "context", F.array(F.lit(-side)).alias("begins"), F.array(F.lit(LENGTH)).alias("ends")
    )
    verdicts = equal
    if n:
        schema = "gram bigint, context bigint, before int, raw binary"
        fetched = texts.select("text").mapInArrow(_contexts(shared), schema)
        fetched = fetched.groupBy("gram", "context").agg(F.min(F.struct("before", "raw")).alias("c"))
        fetched = stage(fetched.select("gram", "context", "c.*"))
        sizes = fetched.groupBy("gram").agg(F.count("*").alias("kinds")).where("kinds > 1")
        fetched = fetched.join(sizes, "gram")
        usual = fetched.where(F.col("kinds") <= GROUP_MOST).drop("kinds")
        tasks = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        usual = usual.repartition(tasks, "gram").sortWithinPartitions("gram", "context")
        schema = "gram bigint, context bigint, begins array<int>, ends array<int>"
        verdicts = equal.unionByName(usual.mapInArrow(_compare_groups, schema))
        large = fetched.where(F.col("kinds") > GROUP_MOST).drop("kinds")
        if large.limit(1).count():
            verdicts = verdicts.unionByName(_counted_spans(large))
    spans = F.zip_with(
        "begins", "ends", lambda a, b: F.struct((F.col("pos") + a).alias("begin"), (F.col("pos") + b).alias("end"))
    )
    met = anchors.join(verdicts, ["gram", "context"]).select(*KEY, spans.alias("spans"))
    # A row gathers the spans of its own anchors.
    return met.groupBy(*KEY).agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        for text, spans in zip(batch.column(1), batch.column(2)):
            raw = _bytes(text)
            runs: list[list[int]] = []
            if spans.is_valid:
                # A span is a struct of begin and end; plain numbers are quicker to read.
                pairs = spans.values
                for a, b in sorted(zip(pairs.field(0).to_pylist(), pairs.field(1).to_pylist())):
                    a, b = max(0, a), min(len(raw), b)
                    if runs and a <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], b)
                    else:
                        runs.append([a, b])
            kept, done = [], 0
            for a, b in runs:
                kept.append(raw[done:a])
                done = b
            rest = b"".join([*kept, raw[done:]])
            out.append((len(raw), len(raw) - len(rest), len(runs), rest))
        columns = list(zip(*out)) if out else [()] * 4
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        yield pa.record_batch(
            [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
        )


def deduplicated(df: DataFrame) -> DataFrame:
    """`doc_id, n_bytes, n_removed, n_spans, kept` of every row; `kept` is bytes, as cuts may split a character."""
    rows = df.select(df["doc_id"], text_or_empty(df).alias("text"), *row_key(df))
    met = rows.join(repeated_spans(df), KEY, "left").select("doc_id", "text", "spans")
    kind = df.schema["doc_id"].dataType.simpleString()
    return met.mapInArrow(_cut, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")

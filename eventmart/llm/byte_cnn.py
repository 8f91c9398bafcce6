"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes pass `FILTERS` learned filters of `WIDTH` bytes; a filter is a table of a weight for each
place and byte value. The responses of overlapping chunks (`CHUNK` bytes, a step of half a chunk) that
cover the whole document are max-pooled; the mean, the maximum and the minimum over all chunks go through one
logistic unit to the probability of label 1.

Fitting uses a bounded sample of labelled rows: at most `PER_CLASS` rows of each label, those of the smallest
hashes, of at most `MOST_BYTES` characters; the class shares of all labelled rows correct the
sample's. Rows whose crc32(doc_id) mod 5 is 0 are held out. Only the text enters a score.

Edge cases: null text is empty and scored as such; a text of any length is scored whole in slices; labels of
unknown documents and documents without labels do not meet; several labels of one row all count; without
labels of both kinds every score is the share of label 1 (0.5 without any); a null id is scored and
never trained on; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.text import keep_columns

FILTERS = 24
WIDTH = 5
CHUNK = 256
PER_CLASS = 1500
MOST_BYTES = 1 << 14
EPOCHS = 10
BATCH = 16
RATE = 0.01
THRESHOLD = 0.3
#: Half chunks convolved at a time.
SLICE = 128
HALF = CHUNK // 2

Params = dict[str, np.ndarray]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def half_maxima(p: Params, data: np.ndarray, where: bool = False):
    """The largest response of each filter in each half chunk, and with `where` the place of it.

    Bytes past the end are zeros, which filters learn as such; every text has two half chunks at least.
    """
    halves = max(2, -(-len(data) // HALF))
    padded = np.zeros(halves * HALF + WIDTH - 1, np.uint8)
    padded[: len(data)] = data
    top, place = np.empty((halves, FILTERS), np.float32), np.empty((halves, FILTERS), np.int64) if where else None
    for a in range(0, halves, SLICE):
        b = min(halves, a + SLICE)
        part = padded[a * HALF : b * HALF + WIDTH - 1]
        n = (b - a) * HALF
        z = p["T"][0][part[:n]]
        for k in range(1, WIDTH):
            z += p["T"][k][part[k : k + n]]
        z = z.reshape(b - a, HALF, FILTERS)
        if where:
            at = z.argmax(axis=1)
            place[a:b] = at + (np.arange(a, b) * HALF)[:, None]
            top[a:b] = np.take_along_axis(z, at[:, None, :], axis=1)[:, 0]
        else:
            top[a:b] = z.max(axis=1)
    return top, place, padded


def probability(p: Params, data: np.ndarray) -> float:
    top, _, _ = half_maxima(p, data)
    chunks = np.maximum(np.maximum(top[1:], top[:-1]) + p["b"], 0)
    logit = float(np.concatenate((chunks.mean(axis=0), chunks.max(axis=0), chunks.min(axis=0))) @ p["w"] + p["a"][0])
    return 1 / (1 + np.exp(-max(-60.0, min(60.0, logit))))


def gradient(p: Params, data: np.ndarray, label: int) -> tuple[float, Params]:
    """Loss and gradients of one text."""
    top, place, padded = half_maxima(p, data, where=True)
    first = top[:-1] >= top[1:]
    best = np.where(first, top[:-1], top[1:])
    at = np.where(first, place[:-1], place[1:])
    chunks = np.maximum(best + p["b"], 0)
    n, cols = len(chunks), np.arange(FILTERS)
    widest, least = chunks.argmax(axis=0), chunks.argmin(axis=0)
    x = np.concatenate((chunks.mean(axis=0), chunks[widest, cols], chunks[least, cols]))
    y = 1 / (1 + np.exp(-np.clip(x @ p["w"] + p["a"][0], -60, 60)))
    d = np.float32(y - label)
    grad = {"w": d * x, "a": np.array([d], np.float32), "T": np.zeros_like(p["T"])}
    dc = np.repeat(d * p["w"][None, :FILTERS] / n, n, axis=0)
    dc[widest, cols] += d * p["w"][FILTERS : 2 * FILTERS]
    dc[least, cols] += d * p["w"][2 * FILTERS :]
    dc = np.where(chunks > 0, dc, 0)
    grad["b"] = dc.sum(axis=0)
    for k in range(WIDTH):
        np.add.at(grad["T"][k], (padded[at + k], np.broadcast_to(cols, at.shape)), dc)
    return -float(np.log(max(y if label else 1 - y, 1e-9))), grad


def fit(sample: list[tuple[bytes, int]], share: float, seed: int = 5, epochs: int = EPOCHS) -> Params:
    """Adam over the sample; the bias is then moved from the sample's class shares to `share`."""
    rng = np.random.default_rng(seed)
    p = {
        "T": rng.normal(0, 0.1, (WIDTH, 256, FILTERS)).astype(np.float32),
        "b": np.zeros(FILTERS, np.float32),
        "w": rng.normal(0, 0.3, 3 * FILTERS).astype(np.float32),
        "a": np.zeros(1, np.float32),
    }
    ones = sum(label for _, label in sample)
    if not 0 < ones < len(sample):
        p["w"][:] = 0
        p["a"][0] = np.log(max(share, 1e-3) / max(1 - share, 1e-3))
        return p
    data = [(np.frombuffer(text, np.uint8), label) for text, label in sample]
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for a in range(0, len(order), BATCH):
            some = order[a : a + BATCH]
            total = {k: np.zeros_like(x) for k, x in p.items()}
            for i in some:
                for k, g in gradient(p, *data[i])[1].items():
                    total[k] += g / len(some)
            step += 1
            for k, g in total.items():
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.001 * (g * g - v[k])
                p[k] -= RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-7)
    p["a"][0] += np.log(share / (1 - share)) - np.log(ones / (len(sample) - ones))
    return p


def fitted(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Params:
    """Parameters fitted on the bounded sample; the driver holds at most 2 x `per_class` texts of `MOST_BYTES` characters."""
    marks = labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("_label"))
    marks = marks.where("_id is not null and _label in (0, 1)").where(~held_out(F.col("_id")))
    counts = {r[0]: r[1] for r in marks.groupBy("_label").count().collect()}
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.5
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    # Ids first, so that no text is shuffled; the chosen ids, 2 x `per_class` at most, then fetch their texts.
    known = docs.select(docs["doc_id"].alias("_id"), F.length(text).alias("_size")).where(F.col("_size") <= MOST_BYTES)
    known = known.join(marks, "_id").select("_id", "_label")
    chosen = [r for k in (0, 1) for r in known.where(F.col("_label") == k).orderBy(F.xxhash64("_id"), "_id").limit(per_class).collect()]
    if not chosen:
        return fit([], share)
    ids = docs.sparkSession.createDataFrame(chosen, known.schema)
    rows = docs.where(F.length(text) <= MOST_BYTES).select(docs["doc_id"].alias("_id"), text.alias("_text"))
    rows = rows.join(F.broadcast(ids.distinct()), "_id").orderBy("_id", "_label", "_text").limit(2 * per_class)
    sample = [(r["_text"].encode("utf-8", "surrogatepass"), r["_label"]) for r in rows.collect()]
    return fit(sample, share)


def scored(docs: DataFrame, p: Params, threshold: float = THRESHOLD) -> DataFrame:
    """`doc_id, held_out, score, predicted` of every document, read from its text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(p)  # 80 kB

    def run(batches):
        p = shared.value
        for batch in batches:
            scores = [
                probability(p, np.frombuffer((t.as_py() or "").encode("utf-8", "surrogatepass"), np.uint8)) for t in batch.column(1)
            ]
            yield pa.record_batch([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = keep_columns(docs, ["doc_id", "text"]).mapInArrow(run, f"doc_id {kind}, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

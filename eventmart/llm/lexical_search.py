"""Ranked lexical search: a hybrid of term-at-a-time and document-at-a-time evaluation.

Documents stay where they are: one scan keeps of every document its number of terms and the frequencies of the
terms that some item asks for, and stores them. Corpus figures (documents, terms, document frequencies) are sums
over that table. A second scan evaluates each stretch of `SEGMENT` documents:

* the short posting lists of an item are added up term at a time into accumulators;
* the accumulators are then one more list, with a bound for each block of `BLOCK` documents; their `k`-th largest value
  is the first threshold, since the long lists can only add;
* the long lists are walked document at a time from the highest bound on: blocks, and then documents, whose score so far plus the bounds of
  the lists still to come stays under the threshold are skipped, the rest look their posting up.

A task keeps `k` documents an item across its stretches and the best of all tasks are ranked. Scores are exact
64-bit integers, so skipping changes no result. Items are taken in blocks of about `ITEM_BYTES` of text, whose terms every task holds;
each block scans the documents again.

Edge cases: null text has no terms; a document or item without terms is in no result; documents with equal scores come by ascending
id, null ids last; each row is a document and each row an item of its own, also where ids repeat; items with a null id
are ranked under it; texts are read whole; other columns are not read; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.text import keep_columns
from eventmart.session import stage

K = 10
#: Documents evaluated at a time, and documents that share a bound.
SEGMENT = 1 << 15
BLOCK = 64
#: A list is long if it holds more than one in so many documents of the stretch.
LONG = 16
#: Text of the items whose terms the tasks hold at once.
ITEM_BYTES = 16 << 20
NO_ID = np.iinfo(np.int64).max

FOLD = bytes(ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(128)) + bytes(range(128, 256))


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and other characters beyond ASCII; A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


def _postings(shared):
    """Per document with a term: its id, number of terms, and the asked terms with their frequencies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            kept, sizes, ends, terms, counts = [], [], [0], [], []
            for i, text in enumerate(batch.column(1)):
                words = terms_of(text.as_py())
                if not words:
                    continue
                ids, n = np.unique(np.array([known[w] for w in words if w in known], np.int32), return_counts=True)
                kept.append(i)
                sizes.append(len(words))
                ends.append(ends[-1] + len(ids))
                terms.append(ids)
                counts.append(n)
            flat = lambda parts, kind: pa.array(np.concatenate([np.empty(0, kind), *parts]).astype(kind))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat(x, k)) for x, k in ((terms, np.int32), (counts, np.int64))]
            yield pa.record_batch([batch.column(0).take(pa.array(kept, pa.int64())), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "tf"])

    return run


class Stretch:
    """The posting lists of up to `SEGMENT` documents with their score parts."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tf: np.ndarray, weights: np.ndarray, n_docs: int, n_terms: int):
        self.ids, self.n_blocks = ids, -(-len(ids) // BLOCK)
        length = 10 + (90 * n * n_docs) // n_terms
        doc = np.repeat(np.arange(len(ids)), sizes)
        part = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * length[doc]))
        order = np.argsort(terms, kind="stable")
        self.doc, self.part = doc[order], part[order]
        self.at = np.searchsorted(terms[order], np.arange(len(weights) + 1))
        self.bounds: dict[int, np.ndarray] = {}

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.at[term], self.at[term + 1]
        return self.doc[a:b], self.part[a:b]

    def block_bounds(self, term: int) -> np.ndarray:
        if term not in self.bounds:
            doc, part = self.postings(term)
            self.bounds[term] = best = np.zeros(self.n_blocks, np.int64)
            np.maximum.at(best, doc // BLOCK, part)
        return self.bounds[term]

    def best(self, terms: np.ndarray, least: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that may be among the `k` best at a score of `least` or more, with their whole scores."""
        lengths = self.at[terms + 1] - self.at[terms]
        short = terms[(lengths > 0) & (lengths * LONG <= len(self.ids))]
        long = terms[lengths * LONG > len(self.ids)]
        summed = np.zeros(len(self.ids), np.int64)
        for term in short:
            doc, part = self.postings(term)
            summed[doc] += part
        least = max(least, 1, self._kth(summed, k))
        bounds = [self.block_bounds(t) for t in long]
        order = np.argsort([-b.max() for b in bounds], kind="stable")
        to_come = np.sum(bounds, axis=0) if bounds else np.zeros(self.n_blocks, np.int64)
        padded = np.zeros(self.n_blocks * BLOCK, np.int64)
        padded[: len(summed)] = summed
        open_blocks = np.flatnonzero(padded.reshape(-1, BLOCK).max(axis=1) + to_come >= least)
        at = (open_blocks[:, None] * BLOCK + np.arange(BLOCK)).ravel()
        at = at[at < len(self.ids)]
        at = at[summed[at] + to_come[at // BLOCK] >= least]
        score, rest = summed[at], to_come[at // BLOCK]
        for i in order.tolist():
            doc, part = self.postings(long[i])
            found = np.minimum(np.searchsorted(doc, at), len(doc) - 1)
            score = score + np.where(doc[found] == at, part[found], 0)
            rest = rest - bounds[i][at // BLOCK]
            least = max(least, self._kth(score, k))
            stays = score + rest >= least
            at, score, rest = at[stays], score[stays], rest[stays]
        return at[score >= least], score[score >= least]

    @staticmethod
    def _kth(scores: np.ndarray, k: int) -> int:
        return int(np.partition(scores, -k)[-k]) if len(scores) >= k else 0


def _ranked(shared, k: int):
    """The `k` best documents of every item within a partition of the posting table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights, n_docs, n_terms = shared.value
        asked = [t[weights[t] > 0] for _, t in items]
        tops = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in items]

        def evaluate(table: pa.Table) -> None:
            terms, tf = table.column("terms").combine_chunks(), table.column("tf").combine_chunks()
            ids = table.column("doc_id").fill_null(NO_ID).to_numpy()
            stretch = Stretch(
                ids, table.column("n").to_numpy(), terms.value_lengths().to_numpy(), terms.flatten().to_numpy(), tf.flatten().to_numpy(), weights, n_docs, n_terms
            )
            for i, own in enumerate(asked):
                if not len(own):
                    continue
                score, doc = tops[i]
                at, more = stretch.best(own, int(score[-1]) if len(score) == k else 1, k)
                score, doc = np.concatenate((score, more)), np.concatenate((doc, ids[at]))
                order = np.lexsort((doc, -score))[:k]
                tops[i] = score[order], doc[order]

        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= SEGMENT:
                evaluate(pa.Table.from_batches(held))
                held, n = [], 0
        if n:
            evaluate(pa.Table.from_batches(held))
        item = np.repeat(np.array([no for no, _ in items], np.int64), [len(s) for s, _ in tops])
        score, doc = (np.concatenate([np.empty(0, np.int64), *x]) for x in zip(*tops))
        yield pa.record_batch([pa.array(item), pa.array(doc, mask=doc == NO_ID), pa.array(score)], ["item", "doc_id", "score"])

    return run


def ranked(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """`item_id, rank, doc_id, score`: the `k` best documents of every item with a score above 0."""
    spark = docs.sparkSession
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    numbered = stage(keep_columns(items, ["item_id", "text"]).withColumn("item", F.monotonically_increasing_id()))
    size = numbered.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-size // ITEM_BYTES))
    best = None
    for block in range(n_blocks):
        of_block = numbered.where(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == block)
        told = [(r.item, sorted(set(terms_of(r.text)))) for r in of_block.select("item", "text").collect()]
        if not told:
            continue
        number = {t: i for i, t in enumerate(sorted({t for _, own in told for t in own}))}
        known = spark.sparkContext.broadcast(number)
        index = stage(docs.mapInArrow(_postings(known), "doc_id bigint, n bigint, terms array<int>, tf array<bigint>"))
        n_docs, n_terms = index.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        # One row per term of the block's items.
        met = dict(index.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
        weights = np.zeros(len(number), np.int64)
        for term, df in met.items():
            weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        asked = [(no, np.array([number[t] for t in own], np.int64)) for no, own in told]
        shared = spark.sparkContext.broadcast((asked, weights, n_docs, n_terms))
        top = index.mapInArrow(_ranked(shared, k), "item bigint, doc_id bigint, score bigint")
        best = top if best is None else best.unionByName(top)
    if best is None:
        return numbered.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")

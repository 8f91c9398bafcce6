"""Benchmark decontamination by templates: typed placeholders, joined windows, consistent slots.

Words lose outer punctuation and case; numbers, names and units become `<num>`, `<name>` and
`<unit>`, their values being slots. Windows of five template tokens of documents and items
meet in a hash join. Windows of one document and item on one diagonal are an alignment; it
counts if its slots are consistent: an item's value stands for one document value throughout,
so a question with other numbers and names is found and a chance meeting of patterns is not.
An item leaks into a document if counted windows cover 80 % of its tokens or more.

Items are never broadcast: a filter of bounded size, built from their windows, lets a document's task
drop the windows that no item has; the rest are joined exactly, by hash and by the window itself.

A name is a capitalised word inside a sentence, neighbouring ones being one name. Line breaks are no tokens. A text
is read with breaks as blanks, so that other line widths change nothing; where a line begins with a
capital it is read a second time with breaks as sentence starts, for lists of capitalised lines. An item is found if one of
its readings is. Items of fewer than five tokens
are matched by one window of their own length, down to `LEAST_TOKENS`; shorter ones cannot
be told apart from chance and never match.

Edge cases: null or empty texts have no windows; a window of nothing but placeholders is not used;
an item or document repeated under one id counts once; a null document id is reported as
null and stays in `decontaminated`; other columns are not read; empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.bits import build_filter, may_hold
from eventmart.llm.text import keep_columns

WINDOW = 5
LEAST_TOKENS = 3
COVERED = 0.8
CONSISTENT = 0.8

#: Unit words and written numbers.
UNITS = frozenset(
    "mm cm m km inch inches ft feet foot yard yards mile miles g kg mg lb lbs pound pounds ounce ounces ton tons ml l liter "
    "liters litre litres gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks month "
    "months year years cent cents dollar dollars euro euros usd eur percent degree degrees kmh mph volt volts watt watts".split()
)
NUMBERS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million".split()
)
OUTER = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”‘’„…¿¡。！？、·•–—€£"
NUMBER = re.compile(r"[0-9][0-9.,:/]*")
BREAK = "\x00"
DROPPED, WORD, NUM, UNIT, NAME = range(5)
PLACEHOLDER = {NUM: "<num>", UNIT: "<unit>", NAME: "<name>"}
#: Words whose analysis a task remembers.
MEMORY = 300_000


class Canonical:
    """Template tokens of a text, with a memory of words."""

    def __init__(self):
        from xxhash import xxh64_intdigest

        self.hash = xxh64_intdigest
        self.marks = np.array([0, 0, *(self.hash(PLACEHOLDER[k]) for k in (NUM, UNIT, NAME))], np.uint64)
        self.reset()

    def reset(self) -> None:
        self.ids: dict[str, int] = {}
        self.cores: list[str] = []
        # One row per word: kind, ends a sentence, hash; filled as words are met.
        self.kinds = np.zeros(MEMORY * 2, np.uint8)
        self.ends = np.zeros(MEMORY * 2, bool)
        self.hashes = np.zeros(MEMORY * 2, np.uint64)

    def learn(self, word: str) -> int:
        core = word.strip(OUTER)
        low = core.lower()
        if not core or core == BREAK:
            kind = DROPPED
        elif NUMBER.fullmatch(core) or low in NUMBERS:
            kind = NUM
        elif low in UNITS:
            kind = UNIT
        elif core[0].isupper() and core[1:].lower() == core[1:]:
            kind = NAME
        else:
            kind = WORD
        self.ids[word] = n = len(self.cores)
        self.cores.append(low)
        if n == len(self.kinds):
            self.kinds, self.ends, self.hashes = (np.concatenate((a, np.zeros_like(a))) for a in (self.kinds, self.ends, self.hashes))
        self.kinds[n] = kind
        self.ends[n] = word.rstrip("\"'”’»)]")[-1:] in tuple(".?!:;…。！？")
        self.hashes[n] = self.hash(low) if kind else 0
        return n

    def __call__(self, text: str) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Kinds, hashes and word numbers of the tokens that stay: with breaks as blanks, and as sentence starts if that differs."""
        if len(self.cores) > MEMORY:
            self.reset()
        words = text.replace(BREAK, " ").replace("\n", f" {BREAK} ").split()
        known, learn = self.ids, self.learn
        ids = np.array([known[w] if w in known else learn(w) for w in words], np.int64)
        at = np.flatnonzero(ids != known.get(BREAK, -1))
        ids, broken = ids[at], np.concatenate(([False], np.diff(at) > 1)) if len(at) else np.zeros(0, bool)
        kinds, ends = self.kinds[ids], self.ends[ids]
        first = np.concatenate(([True], ends[:-1])) if len(ids) else ends
        out = [self.template(ids, kinds, first)]
        if ((kinds == NAME) & broken & ~first).any():
            out.append(self.template(ids, kinds, first | broken))
        return out

    def template(self, ids: np.ndarray, kinds: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashes = self.hashes[ids]
        kinds = np.where((kinds == NAME) & first, WORD, kinds)
        stays = np.flatnonzero(kinds != DROPPED)
        kinds, hashes, ids = kinds[stays], hashes[stays], ids[stays]
        again = np.zeros(len(kinds), bool)
        again[1:] = (kinds[1:] == NAME) & (kinds[:-1] == NAME)
        kinds, hashes, ids = kinds[~again], hashes[~again], ids[~again]
        return kinds, np.where(kinds > WORD, self.marks[kinds], hashes), ids


def window_hashes(tokens: np.ndarray, length: int) -> np.ndarray:
    base, out = np.uint64(0x9E3779B97F4A7C15), np.zeros(max(0, len(tokens) - length + 1), np.uint64)
    for j in range(length):
        out = out * base + tokens[j : j + len(out)]
    return out


def _windows(lengths, bits, with_size: bool):
    """A mapper from (id, text) to rows (h, window, id, reading, pos, slots[, size]); `lengths` None: one length, the text's own up to `WINDOW`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canonical = Canonical()
        held = bits.value if bits else None
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for reading, (kinds, tokens, ids) in enumerate(canonical(text.as_py() or "")):
                    for length in lengths or ([min(WINDOW, len(tokens))] if len(tokens) >= LEAST_TOKENS else []):
                        h = window_hashes(tokens, length)
                        hits = np.arange(len(h)) if held is None else np.flatnonzero(may_hold(held, h))
                        for at in hits.tolist():
                            row = kinds[at : at + length].tolist()
                            if min(row) > WORD:
                                continue
                            words = [canonical.cores[i] for i in ids[at : at + length].tolist()]
                            window = " ".join(PLACEHOLDER.get(k, w) for k, w in zip(row, words))
                            slots = [w for k, w in zip(row, words) if k > WORD]
                            out.append((int(h[at].astype(np.int64)), window, doc, reading, at, slots, len(tokens)))
            kinds_ = (pa.int64(), pa.string(), batch.column(0).type, pa.int32(), pa.int32(), pa.list_(pa.string()), pa.int32())
            columns = [pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 7, kinds_)]
            names = ["h", "window", "id", "reading", "pos", "slots", "size"]
            keep = 7 if with_size else 6
            yield pa.record_batch(columns[:keep], names[:keep])

    return run


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """`doc_id, item_id, covered, item_tokens, similarity, exact`, a row for each item found in a document."""
    item_type = items.schema["item_id"].dataType.simpleString()
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    schema = "h bigint, window string, id {}, reading int, pos int, slots array<string>"
    own = keep_columns(items, ["item_id", "text"]).mapInArrow(_windows(None, None, True), schema.format(item_type) + ", size int")
    own = own.dropDuplicates(["h", "window", "id", "reading", "pos"])
    bits, _ = build_filter(own)
    lengths = sorted(r[0] for r in own.select(F.least("size", F.lit(WINDOW))).distinct().collect())  # WINDOW values at most
    if not lengths:
        lengths = [WINDOW]
    found = keep_columns(docs, ["doc_id", "text"]).mapInArrow(_windows(lengths, bits, False), schema.format(doc_type))
    found = found.select("h", "window", F.col("id").alias("doc_id"), F.col("reading").alias("doc_reading"), "pos", "slots")
    own = own.select("h", "window", F.col("id").alias("item_id"), "reading", F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots"), "size")
    met = found.join(own, ["h", "window"]).where(F.size(F.split("window", " ")) == F.least("size", F.lit(WINDOW)))
    met = met.withColumn("diagonal", F.col("pos") - F.col("item_pos"))
    pairs = F.zip_with("item_slots", "slots", lambda a, b: F.struct(a.alias("item"), b.alias("doc")))
    # A diagonal has a window of an item once, so a group is never longer than the item.
    lined = met.groupBy("doc_id", "item_id", "reading", "doc_reading", "size", "diagonal").agg(
        F.collect_set("item_pos").alias("at"), F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs")
    )
    values = F.size(F.array_distinct(F.transform("pairs", lambda p: p["item"])))
    lined = lined.where(values >= F.lit(CONSISTENT) * F.size("pairs"))
    same = F.forall("pairs", lambda p: p["item"] == p["doc"])
    tokens = F.explode(F.transform("at", lambda a: F.sequence(a, a + F.least("size", F.lit(WINDOW)) - 1)))
    covered = lined.select("doc_id", "item_id", "reading", "size", same.alias("same"), tokens.alias("run"))
    covered = covered.select("doc_id", "item_id", "reading", "size", "same", F.explode("run").alias("token"))
    covered = covered.groupBy("doc_id", "item_id", "reading", "size", "token").agg(F.bool_or("same").alias("same"))
    out = covered.groupBy("doc_id", "item_id", "reading", "size").agg(
        F.count("*").alias("covered"), F.count_if("same").alias("as_is")
    )
    similarity = F.col("covered") / F.col("size")
    exact = F.col("as_is") == F.col("covered")
    # The reading that is covered best stands for the item.
    best = F.max(F.struct(similarity.alias("similarity"), exact.alias("exact"), "size", "covered")).alias("best")
    return out.where(similarity >= COVERED).groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "best.covered", F.col("best.size").cast("long").alias("item_tokens"), "best.similarity", "best.exact"
    )


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that no item leaks into; rows without an id stay."""
    bad = leaks(docs, items).select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(*docs.columns)

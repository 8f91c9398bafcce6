"""Sanitising personal data: patterns first, then terms that reveal a protected entity.

Protected entities are the e-mail addresses, IP addresses, card and phone numbers that the
patterns find. A term is a word, in lower case without outer punctuation, within `REACH` words of an
entity. Over the whole corpus, with documents as the unit of counting,

    P(entity | term) = documents with the term beside the entity / documents with the term
    disclosure       = log2(P(entity | term) / P(entity))

A term discloses an entity when P(entity | term) >= `GENERALISE` and disclosure >= `LEAST_BITS`: it is then
generalised wherever it stands, beside the entity or not, and removed when P(entity | term) >= `REMOVE`.

A pair met in fewer than `SUPPORT` different texts has little evidence, so its P(entity | term) is shrunk towards
P(entity): with s texts, d documents of them and the plain share q it is (s + w P(entity)) / (s / q + w). The prior
weight w is `PRIOR` documents for each document of a text, d / s, as words of a text that stands many times
are rather its own than a person's. So a term met once, in one text, beside an entity is generalised (2/3), one met
twice and once of it beside the entity is not (2/5), and two of two are removed (4/5). Variants of an
entity count as one: case, separators, leading zeros of addresses, and what follows a plus sign in a mailbox.

Three scans: entities and the terms beside them; document counts of those terms; spans. Terms
reach the tasks as a filter of bounded size and are matched exactly in joins, so neither
entities nor terms are held whole anywhere, and an entity of any frequency is
counted by partial sums.

Spans are (kind, start, end) in code points, end exclusive. Base matches are leftmost and do
not overlap within a kind; a match that fails its test is dropped.

Edge cases: null text is empty; a text without entities still gets spans of disclosing terms; copies
count as documents but not as different texts; repeated rows are treated each; a null id is
passed on; other columns are kept by `sanitised` and not read; empty tables give no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.bits import build_filter, may_hold
from eventmart.llm.text import free_name, keep_columns
from eventmart.session import stage

REACH = 5
SUPPORT = 3
#: Weight of P(entity), in documents, where a pair has fewer texts.
PRIOR = 0.5
GENERALISE = 0.5
REMOVE = 0.8
LEAST_BITS = 5.0

KINDS = ("email", "ip", "card", "phone", "term")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match always begins where a run of digits does, so the look-behind only saves time.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
#: Words lie between blanks of any kind, as `str.split` cuts them.
TOKEN = re.compile(r"\S+")
OUTER = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”‘’„…¿¡。！？、·•–—€£"
MASK = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]", "gone": ""}
TERMS_HELD = 200_000


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the address pattern, found from each `@` outwards: linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every base match, sorted."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            # A part has few digits unless it leads with zeros; compare without building a huge number.
            if all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in m[0].split("."))):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() <= 37 and 12 <= len(d := NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


class Taken:
    """Which stretches of a text spans cover, asked in logarithmic time."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, _, b in spans:
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def __call__(self, begin: int, end: int) -> bool:
        i = bisect_right(self.ends, begin)
        return i < len(self.starts) and self.starts[i] < end


def _entity(text: str, start: int, kind: int, end: int) -> str:
    value = text[start:end]
    if kind > 1:
        value = NOT_DIGIT.sub("", value)
    elif kind == 1:
        value = ".".join(p.lstrip("0") or "0" for p in value.split("."))
    else:
        box, _, host = value.lower().partition("@")
        value = f"{box.partition('+')[0] or box}@{host}"
    return f"{KINDS[kind]}:{value}"


def term_of(word: str) -> str | None:
    core = word.strip(OUTER).lower()
    return core if len(core) >= 3 and any(c.isalpha() for c in core) and "@" not in core else None


def _hash(term: str) -> int:
    """What Spark's xxhash64 gives, unsigned."""
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(term, 42)


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each entity of a document: the terms beside it and a hash of the text."""
    for batch in batches:
        entities, terms, texts = [], [], []
        for value in batch.column(0):
            text = value.as_py() or ""
            spans = base_spans(text)
            if not spans:
                continue
            words = [(m.start(), m.end(), m[0]) for m in TOKEN.finditer(text)]
            begins = [w[0] for w in words]
            near: dict[str, set[str]] = {}
            taken = Taken(spans)
            for start, kind, end in spans:
                first = max(0, bisect_right(begins, start) - 1)
                last = bisect_left(begins, end)
                held = near.setdefault(_entity(text, start, kind, end), set())
                for w in words[max(0, first - REACH) : first] + words[last : last + REACH]:
                    if not taken(w[0], w[1]) and (t := term_of(w[2])):
                        held.add(t)
            h = _signed(_hash(text))
            for e, found in near.items():
                entities.append(e)
                terms.append(sorted(found))
                texts.append(h)
        yield pa.record_batch(
            [pa.array(entities, pa.string()), pa.array(terms, pa.list_(pa.string())), pa.array(texts, pa.int64())],
            ["entity", "terms", "text"],
        )


class TermTest:
    """Which words may be terms of a filter, remembered word by word."""

    def __init__(self, words: np.ndarray):
        self.words, self.known = words, {}

    def __call__(self, words: list[str]) -> list[str]:
        """The terms of these words that the filter lets through, once each."""
        known = self.known
        fresh = [w for w in words if w not in known]
        if fresh:
            if len(known) + len(fresh) > TERMS_HELD:
                known.clear()
                fresh = words
            terms = [term_of(w) for w in fresh]
            hashes = np.array([_hash(t) if t else 0 for t in terms], np.uint64)
            for w, t, hit in zip(fresh, terms, may_hold(self.words, hashes).tolist()):
                known[w] = t if hit and t else None
        return [t for w in words if (t := known[w])]


def _count_terms(shared):
    def run(batches):
        test, counts = TermTest(shared.value), Counter()

        def flush():
            rows = pa.record_batch([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["term", "n"])
            counts.clear()
            return rows

        for batch in batches:
            for value in batch.column(0):
                if text := value.as_py():
                    counts.update(set(test(list(set(text.split())))))
            if len(counts) > TERMS_HELD:
                yield flush()
        yield flush()

    return run


def disclosing_terms(df: DataFrame) -> DataFrame:
    """`term, share, bits, removed`: for each disclosing term its strongest P(entity | term) and disclosure."""
    texts = keep_columns(df, ["text"])
    beside = stage(texts.mapInArrow(_beside, "entity string, terms array<string>, text bigint"))
    entities = beside.groupBy("entity").agg(F.count("*").alias("n_entity"))
    rows = beside.select("entity", "text", F.explode("terms").alias("term"))
    # Copies count once for support: first by text, then over texts.
    by_text = rows.groupBy("entity", "term", "text").agg(F.count("*").alias("n"))
    both = by_text.groupBy("entity", "term").agg(F.sum("n").alias("n_both"), F.count("*").alias("support"))
    both = stage(both.join(entities, "entity"))
    shared, n = build_filter(both.select(F.xxhash64("term").alias("h")))
    if not n:
        return both.select("term", F.lit(0.0).alias("share"), F.lit(0.0).alias("bits"), F.lit(False).alias("removed")).limit(0)
    counted = texts.mapInArrow(_count_terms(shared), "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n_term"))
    total = df.count()
    plain = F.least(F.col("n_both") / F.col("n_term"), F.lit(1.0))
    weight = F.lit(PRIOR) * F.col("n_both") / F.col("support")
    shrunk = (F.col("support") + weight * F.col("n_entity") / F.lit(float(total))) / (F.col("support") / plain + weight)
    share = F.when(F.col("support") >= SUPPORT, plain).otherwise(shrunk)
    scored = both.join(counted, "term").select(
        "term", share.alias("share"), F.log2(share * F.lit(float(total)) / F.col("n_entity")).alias("bits")
    )
    strong = scored.where((F.col("share") >= GENERALISE) & (F.col("bits") >= LEAST_BITS))
    strong = strong.groupBy("term").agg(F.max("share").alias("share"), F.max("bits").alias("bits"))
    return strong.withColumn("removed", F.col("share") >= REMOVE)


def _all_spans(shared, id_kind):
    def run(batches):
        test = TermTest(shared.value) if shared else None
        kinds, hits_type = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])), None
        hits_type = pa.list_(pa.struct([("term", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            spans, hits = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                base = base_spans(text)
                spans.append([{"start": a, "kind": k, "end": b} for a, k, b in base])
                found = []
                if test and (terms := set(test(list(set(text.split()))))):
                    taken = Taken(base)
                    for m in TOKEN.finditer(text):
                        core = m[0].strip(OUTER)
                        if core.lower() in terms:
                            a = m.start() + m[0].index(core)
                            if not taken(a, a + len(core)):
                                found.append({"term": core.lower(), "start": a, "end": a + len(core)})
                hits.append(found)
            yield pa.record_batch([batch.column(0), pa.array(spans, kinds), pa.array(hits, hits_type)], ["id", "base", "hits"])

    return run


def spans_of(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """`row, <key>, base, terms` of every row of `df`: its base spans and the spans of disclosing terms.

    `base` is an array of (start, kind, end), `terms` of (start, kind, end, removed), both sorted.
    """
    terms = stage(disclosing_terms(df))
    shared, n = build_filter(terms.select(F.xxhash64("term").alias("h")))
    kind = df.schema[key].dataType.simpleString()
    schema = (
        f"id {kind}, base array<struct<start:int, kind:int, end:int>>, hits array<struct<term:string, start:int, end:int>>"
    )
    found = keep_columns(df, [key, "text"]).mapInArrow(_all_spans(shared if n else None, kind), schema)
    found = stage(found.withColumn("row", F.monotonically_increasing_id()))
    hits = found.where(F.size("hits") > 0).select("row", F.explode("hits").alias("hit"))
    hits = hits.select("row", "hit.*").join(terms.select("term", "removed"), "term")
    span = F.struct("start", F.lit(4).alias("kind"), "end", "removed")
    # A row gathers its own spans only: no more than its words.
    own = hits.groupBy("row").agg(F.sort_array(F.collect_list(span)).alias("terms"))
    empty = F.expr("cast(array() as array<struct<start:int, kind:int, end:int, removed:boolean>>)")
    out = found.select("row", "id", "base").join(own, "row", "left")
    return out.select("row", F.col("id").alias(key), "base", F.coalesce("terms", empty).alias("terms"))


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, base, terms in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            if text is None:
                out.append(None)
                continue
            marks = [(s["start"], s["end"], KINDS[s["kind"]]) for s in base]
            marks += [(s["start"], s["end"], "gone" if s["removed"] else "term") for s in terms]
            parts, done = [], 0
            for a, b, kind in sorted(marks):
                if a >= done:
                    parts += [text[done:a], MASK[kind]]
                done = max(done, b)
            out.append("".join(parts) + text[done:])
        yield pa.record_batch([batch.column(0), pa.array(out, pa.string())], ["uid", "new"])


def sanitised(df: DataFrame) -> DataFrame:
    """`df` with entities masked, weaker disclosing terms generalised and stronger ones removed."""
    uid, new = free_name(df, "uid"), free_name(df, "new")
    rows = stage(keep_columns(df, df.columns).withColumn(uid, F.monotonically_increasing_id()))
    texts = rows.select(F.col(uid).alias("uid"), F.col("text"))
    spans = spans_of(texts, "uid").where((F.size("base") > 0) | (F.size("terms") > 0)).drop("row")
    touched = texts.join(spans, "uid").select("uid", "text", "base", "terms")
    changed = touched.mapInArrow(_rewrite, "uid bigint, new string").toDF(uid, new)
    out = rows.join(changed, uid, "left").withColumn("text", F.coalesce(new, "text"))
    return out.select(*df.columns)

import math
import random
import re

import numpy as np
import pytest

from eventmart.llm import lexical_search as search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [x.translate(LOWER) for x in TERM.findall(text or "")]


def brute(docs, items, k):
    told = [(d, terms(t)) for d, t in docs]
    n_docs, n_terms = sum(bool(t) for _, t in told), sum(len(t) for _, t in told)
    df = {}
    for _, own in told:
        for t in set(own):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for d, own in told:
            m = 10 + (90 * len(own) * n_docs) // n_terms if own else 0
            score = 0
            for t in set(terms(text)) & set(own):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1000000000 * own.count(t)) // (1000 * own.count(t) + 8 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, i, d, -s) for i, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def texts(rng, n):
    words = ["the", "The", "of", "É", "é", "naïve", "x1", "42"] + [f"w{i}" for i in range(60)]
    weights = [40, 20, 30, 3, 3, 3, 3, 3] + [60 / (i + 1) for i in range(60)]
    return ["".join(w + rng.choice([" ", ", ", "-", "\n"]) for w in rng.choices(words, weights, k=rng.randint(1, 60))) for _ in range(n)]


@pytest.mark.parametrize("segment, block, long, item_bytes", [(1 << 15, 64, 16, 1 << 24), (40, 4, 3, 1 << 24), (25, 7, 100, 300)])
def test_ranks_match_brute_force(spark, monkeypatch, segment, block, long, item_bytes):
    monkeypatch.setattr(search, "BLOCK", block)
    monkeypatch.setattr(search, "LONG", long)
    monkeypatch.setattr(search, "ITEM_BYTES", item_bytes)
    rng = random.Random(segment)
    docs = list(enumerate(texts(rng, 300)))
    docs += [(300, None), (301, ""), (302, " .,\t"), (None, docs[0][1]), (None, None), (303, docs[5][1]), (304, docs[5][1]), (305, "x" * 100_000 + " w3 w4")]
    docs += [(6, docs[6][1])]  # a repeated row
    items = [(i, t) for i, t in enumerate(texts(rng, 25))] + [(90, None), (91, "unknown"), (None, "w3 w4"), (92, docs[7][1]), (93, "the")]
    table = spark.createDataFrame([(d, t, "s", 1) for d, t in docs], "doc_id bigint, text string, n string, item int").repartition(3)
    asked = spark.createDataFrame([(*x, 0) for x in items], "item_id bigint, text string, doc_id int")
    got = sorted((tuple(r) for r in search.ranked(table, asked, 7).collect()), key=str)
    assert got == brute(docs, items, 7)


def test_stretches_skip_nothing_that_counts():
    rng = np.random.default_rng(3)
    n, n_terms = 2000, 30
    held = rng.random((n, n_terms)) < np.linspace(0.002, 0.9, n_terms)
    tf = np.where(held, rng.integers(1, 6, (n, n_terms)), 0)
    sizes = held.sum(axis=1)
    doc, term = np.nonzero(held)
    weights = rng.integers(1, 9000, n_terms)
    own = search.Stretch(np.arange(n), tf.sum(axis=1) + 1, sizes, term, tf[held], weights, n, int(tf.sum()))
    for terms_ in (np.arange(30), np.arange(20, 30), np.arange(5), np.array([29])):
        whole = np.zeros(n, np.int64)
        for t in terms_:
            d, p = own.postings(t)
            whole[d] += p
        at, score = own.best(terms_, 1, 10)
        assert (whole[at] == score).all()
        want = np.sort(whole)[::-1][:10]
        assert (np.sort(score)[::-1][:10] == want).all()
        assert set(np.flatnonzero(whole >= max(1, want[-1]))) <= set(at.tolist())


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert search.ranked(docs.limit(0), items).collect() == []
    assert search.ranked(docs, items.limit(0)).collect() == []
    assert [tuple(r)[:3] for r in search.ranked(docs, items).collect()] == [(1, 1, 1)]

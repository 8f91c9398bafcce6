import random

import pytest

from eventmart.llm import mixing


def brute_targets(sizes):
    """Cap, reshare by weight, again and again."""
    order = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    rest, open_, target = 1.5 * sum(sizes.values()), set(sizes), {s: 0.0 for s in sizes}
    while rest > 1e-9 and open_:
        w = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += rest * weight[s] / w
        rest = sum(max(0, target[s] - 2 * sizes[s]) for s in open_)
        for s in list(open_):
            if target[s] >= 2 * sizes[s]:
                target[s] = 2 * sizes[s]
                open_.discard(s)
    return target


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, size string, p double")


@pytest.mark.parametrize("bucket", [4096, 16])
def test_targets_are_met_within_a_document(spark, monkeypatch, bucket):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket)
    monkeypatch.setattr(mixing, "FAN", 3)
    rng = random.Random(6)
    rows = [(i, " ".join("w" * 1 for _ in range(rng.randint(0, 60))), rng.choice(["b", "a", "é", "Z", None, "b", "b"]), "x", 0.5)
            for i in range(900)]
    rows += [(900, None, "a", None, None), (901, " ", "empty", None, None), (902, "", "none", None, None), rows[3]]
    df = documents(spark, rows)
    got = mixing.decisions(df).collect()
    again = mixing.decisions(df.repartition(5)).collect()
    key = lambda r: (r.doc_id, r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert len(got) == len(rows)
    by_doc = {i: s for i, _, s, _, _ in rows}
    sizes = {}
    for i, t, s, _, _ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").encode().split())
    want = brute_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r.source_size == sizes[by_doc[r.doc_id]] and r.target == pytest.approx(want[by_doc[r.doc_id]])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[by_doc[r.doc_id]] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 60
    copies = mixing.mixed_documents(df)
    assert copies.columns == df.columns
    assert copies.count() == sum(r.copies for r in got)


def test_a_meeting_conserves_words_and_expectations():
    rng = random.Random(1)
    for _ in range(200):
        p, q, s, t = rng.random(), rng.random(), rng.randint(1, 50), rng.randint(1, 50)
        ends = {}
        for k in range(2000):
            a, b = mixing.meet(p, s, q, t, k / 2000)
            assert a * s + b * t == pytest.approx(p * s + q * t, abs=1e-6) and (a in (0, 1) or b in (0, 1))
            ends[(a, b)] = ends.get((a, b), 0) + 1
        assert sum(a * n for (a, _), n in ends.items()) / 2000 == pytest.approx(p, abs=2e-3)


def test_no_words_and_no_rows(spark):
    df = documents(spark, [(1, None, None, None, None), (2, " ", "a", None, None)])
    assert sorted((r.doc_id, r.taken, r.target) for r in mixing.decisions(df).collect()) == [(1, 0, 0.0), (2, 0, 0.0)]
    assert mixing.decisions(df.limit(0)).count() == 0 and mixing.mixed_documents(df.limit(0)).count() == 0

import hashlib
import random

import numpy as np
import pytest

from eventmart.llm import substrings


def brute(texts, length=substrings.LENGTH):
    raws = [(t or "").encode() for t in texts]
    count = {}
    for raw in raws:
        for i in range(len(raw) - length + 1):
            count[raw[i : i + length]] = count.get(raw[i : i + length], 0) + 1
    out = []
    for raw in raws:
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - length + 1):
            if count[raw[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone[:-1]])
        out.append((len(raw), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), kept))
    return out


def texts():
    rng = random.Random(9)
    noise = lambda n: "".join(rng.choice("abcdefé \n") for _ in range(n))
    passages = [noise(n) for n in (150, 190, 199, 200, 201, 260, 700)]
    out = [None, "", "a", "x" * 199, "x" * 200, "x" * 201, "ab" * 400, "abc" * 150 + noise(30), noise(400) * 2]
    for _ in range(60):
        a, b = rng.choice(passages), rng.choice(passages)
        cut = rng.randint(0, len(b))
        out.append(noise(rng.randint(0, 300)) + a + noise(rng.randint(0, 3)) + b[cut:] + noise(rng.randint(0, 250)))
    edited = list(noise(900))
    for _ in range(20):
        edited[rng.randrange(900)] = "#"
        out.append("".join(edited))
    long = noise(3000)
    return out + [long, long, noise(50) + long[500:2500], noise(90_000) + passages[5] + noise(60_000)]


@pytest.mark.parametrize("most", [50_000, 2])
def test_removed_bytes_match_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(substrings, "GROUP_MOST", most)
    monkeypatch.setattr(substrings, "BLOCK", 16)
    all_texts = texts()
    rows = [(i, t, "s", 0) for i, t in enumerate(all_texts)] + [(9, all_texts[9], "s", 0), (None, "q" * 300, "s", 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, uid string, pos int").repartition(4)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in substrings.deduplicated(df).collect())
    want = brute([t for _, t, *_ in rows])
    assert got == sorted((r[0] if r[0] is not None else -1, *w) for r, w in zip(rows, want))


def test_suffix_order_and_extensions():
    rng = random.Random(4)
    rows, groups = [], []
    for g in range(40):
        for _ in range(rng.choice([1, 2, 3, 7, 20])):
            rows.append(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))))
            groups.append(g)
    groups = np.array(groups)
    first = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))
    size = np.diff(np.append(first, len(groups)))
    start, size = np.repeat(first, size), np.repeat(size, size)
    strings = substrings.Strings(rows, 12)
    order = strings.order(start, size)
    assert [(groups[i], rows[i]) for i in order] == sorted(zip(groups, rows))
    strings.extensions(order, start)


def test_a_hash_collision_changes_nothing(monkeypatch):
    rng = random.Random(5)
    before = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 152))) for _ in range(40)]
    after = [b"g" * 48 + bytes(rng.choice([b"x" * 152, b"x" * 100 + b"y" * 52, b"x" * 30])) for _ in range(40)]
    before[3:20] = [before[3]] * 17
    groups = np.array(sorted(i % 4 for i in range(40)))
    plain = substrings.repeated_offsets(groups, before, after)

    def broken(self, a, b):
        raise ArithmeticError

    monkeypatch.setattr(substrings.Strings, "extensions", broken)
    assert plain.any() and (substrings.repeated_offsets(groups, before, after) == plain).all()


def test_empty_table(spark):
    assert substrings.deduplicated(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    kept = substrings.deduplicated(spark.createDataFrame([(1, "é" * 50)], "doc_id bigint, text string")).first()
    assert hashlib.sha256(kept.kept).hexdigest() == hashlib.sha256(("é" * 50).encode()).hexdigest()

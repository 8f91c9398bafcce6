import random

import numpy as np
import xxhash

from eventmart.llm import simhash


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(prints):
    ids = list(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and bin(prints[a] ^ prints[b]).count("1") <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def texts():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 4)))
    out = [None, "", " \t\n", "one", "one two", "ONE Two", "a\x0bb\x0cc d", "x" * 50_000, "w v u t s"]
    base = [word() for _ in range(400)]
    for _ in range(60):
        own = list(base)
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(len(own))] = word()
        out.append(" ".join(own))
    out += [" ".join(word() for _ in range(rng.randint(0, 30))) for _ in range(40)]
    return out + out[:12]


def test_fingerprint_is_the_majority_of_shingle_hashes():
    for text in texts():
        assert simhash.fingerprint(text) & (2**64 - 1) == brute_print(text)


def test_bit_sliced_links_span_the_brute_force_components():
    rng = random.Random(5)
    for n in (1, 2, 63, 64, 65, 300):
        seeds = [rng.getrandbits(64) for _ in range(max(1, n // 8))]
        prints = set()
        while len(prints) < n:
            x = rng.choice(seeds)
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
        prints = np.array(sorted(prints), np.uint64)
        edges = simhash.near_forest(prints)
        assert all(bin(int(prints[a]) ^ int(prints[b])).count("1") <= 3 for a, b in edges)
        root = list(range(n))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in edges:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
        brute = brute_classes(dict(enumerate(map(int, prints))))
        assert [find(i) for i in range(n)] == [brute[i] for i in range(n)]
        assert len(edges) == n - len(set(brute.values()))


def test_classes_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 8)  # so that buckets are cut into tiles
    rows = [(i, t, "src", i) for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, FP string, node int")
    got = {r.doc_id: (r.fp & (2**64 - 1), r.component_id) for r in simhash.classes(df).collect()}
    prints = {i: brute_print(t) for i, t, *_ in rows}
    assert {i: x[0] for i, x in got.items()} == prints
    assert {i: x[1] for i, x in got.items()} == brute_classes(prints)


def test_one_of_each_class_stays_and_repeated_and_null_ids_are_defined(spark):
    text = " ".join(f"w{i}" for i in range(200))
    rows = [(1, text), (2, text), (2, text), (3, "quite another text that stands alone here"), (None, text), (None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = simhash.keep_one(df).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [1, 3]
    assert sum(r.doc_id is None for r in kept) == 2
    assert simhash.classes(df.limit(0)).count() == 0


def test_a_chain_becomes_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 99), (99, 98), (5, 5)], "u bigint, v bigint")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 99: 98, 100: 98}


def test_rows_that_repeat_an_id_stay_by_their_text(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(200)) for c in "ab")
    rows = [(1, one, "x"), (1, two, "y"), (1, one, "z"), (2, two, "x"), (2, two, "x"), (None, one, "n")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, mark string")
    want = None
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        kept = sorted((tuple(r) for r in simhash.keep_one(spark.createDataFrame(order, df.schema).repartition(2)).collect()), key=str)
        assert len(kept) == 3 and {r[:2] for r in kept} == {(1, one), (1, two), (None, one)}
        want = want or kept
        assert kept == want

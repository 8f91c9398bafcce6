import hashlib
import random
import zlib

import pytest

from eventmart.llm import prefix_trie as trie


def brute(lists):
    """Nodes of {conv: [(role, text), ...]}, as rows."""
    members = {}
    for conv, turns in lists.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    kids = {p: [q for q in members if len(q) == len(p) + 1 and q[: len(p)] == p] for p in members}
    out = set()
    for p, convs in members.items():
        below = [q for q in members if q[: len(p)] == p]
        saved = sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q)
        ends = ",".join(str(c) for c in sorted(convs) if len(lists[c]) == len(p))
        up = min(members[p[:-1]]) if p else None
        leaves = sum(not kids[q] for q in below)
        out.add((min(convs), len(p), up, len(convs), len(kids[p]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def rows(df):
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def frame(spark, lists):
    told = [(c, t, r, x, "clash") for c, turns in lists.items() for t, (r, x) in enumerate(turns)]
    random.Random(1).shuffle(told)
    return spark.createDataFrame(told, "conv_id bigint, turn bigint, role string, text string, key string")


def talk(rng, words):
    return [("user" if i % 2 == 0 else "assistant", rng.choice(words)) for i in range(rng.randint(1, 5))]


@pytest.mark.parametrize("task_bytes", [120, 3000, 1 << 25])
def test_nodes_match_brute_force_however_many_tasks(spark, task_bytes):
    rng = random.Random(task_bytes)
    lists = {c * 3: talk(rng, ["a", "bé", "", "long text"]) for c in range(90)}
    lists |= {1000 + c: [("user", "same"), ("assistant", "same")] for c in range(60)}  # a hot sequence over many tasks
    lists |= {5000: [("user", "x")] * 40, 5001: [("user", "x")] * 25}  # deep, one a prefix of the other
    got = rows(trie.nodes(trie.turn_lists(frame(spark, lists)), task_bytes))
    assert got == brute(lists)


def test_shared_openings(spark):
    rng = random.Random(4)
    lists = {c: talk(rng, ["a", "b", "c"]) for c in [*range(0, 40), *range(100, 130), *range(250, 260), 300, 7]}
    rebuilt = {}
    for c, own in lists.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = lists.get(c - c % 100, [])[:h] + own[h:]
    assert any(not x for x in rebuilt.values())  # turnless ones are members of the root
    got = rows(trie.nodes(trie.shared_openings(trie.turn_lists(frame(spark, lists))), 400))
    assert got == brute(rebuilt)


def test_nulls_ties_repeats_and_empty_tables(spark):
    told = [(1, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 0, "user", "z")]
    told += [(2, None, "", ""), (2, 5, "user", "c")]
    df = spark.createDataFrame(told, "conv_id bigint, turn bigint, role string, text string")
    ties = sorted(["a", "a", "b"], key=lambda x: hashlib.sha256(f"4:user{x}".encode()).hexdigest())
    lists = {1: [("", ""), *(("user", x) for x in ties)], 2: [("", ""), ("user", "c")]}
    assert rows(trie.nodes(trie.turn_lists(df))) == brute(lists)
    assert trie.nodes(trie.turn_lists(df.limit(0))).collect() == []


def test_layouts_grow_and_keep_their_order():
    rng = random.Random(2)
    for width in (1, 2, 3):
        keys = {bytes(rng.randrange(256) for _ in range(width * rng.randint(0, 4))) for _ in range(1500)}
        keys |= {bytes([b] * width) for b in range(256)}
        order = sorted(keys)
        for told in (order, rng.sample(order, len(order))):
            tree = trie.RadixTree()
            for key in told:
                tree.insert(key, trie.Leaf([int.from_bytes(key, "big")], []))
            layouts, found, todo = set(), [], [(tree.root, b"")]
            while todo:
                node, above = todo.pop()
                path = above + node.path
                layouts.add(node.layout)
                assert len(node.in_order()) <= node.layout and (node.leaf or len(node.in_order()) > 1 or path == b"")
                if node.leaf:
                    found.append(path)
                below = [(node.child(b), path + bytes([b])) for b in range(256) if node.child(b)]
                assert [c for c, _ in below] == node.in_order()
                todo.extend(reversed(below))
            assert found == order
            assert 256 in layouts and 4 in layouts

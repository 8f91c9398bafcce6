import random

import numpy as np
import tiktoken

from eventmart.llm import packing


def test_word_memory_gives_the_ids_of_the_whole_text():
    ranks = packing.read_ranks(open(packing.VOCABULARY, "rb").read())
    plain = tiktoken.Encoding("p", pat_str=packing.PATTERN, mergeable_ranks=ranks, special_tokens={})
    words = packing.WordIds(ranks, "<u2")
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "\t", " ", "a", "The", "é", "'s", "'ll", "12", "!?", "<|endoftext|>", "日本", "\r\n", "."]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert np.frombuffer(words(text), "<u2").tolist() == plain.encode_ordinary(text), repr(text)


def brute_bfd(sizes, length):
    rooms, rows = [], []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [r for r in rooms if r >= sizes[i]]
        if fits:
            k = max(j for j, r in enumerate(rooms) if r == min(fits))
            rooms[k] -= sizes[i]
            rows[k].append(i)
        else:
            rooms.append(length - sizes[i])
            rows.append([i])
    return sorted(length - r for r in rooms)


def test_best_fit_decreasing_fills_like_a_linear_search():
    rng = random.Random(2)
    for length in (1, 7, 64, 100):
        sizes = [rng.randint(1, length) for _ in range(300)]
        rows = packing.best_fit_decreasing(sizes, length)
        assert sorted(i for r in rows for i in r) == list(range(300))
        assert sorted(sum(sizes[i] for i in r) for r in rows) == brute_bfd(sizes, length)


def test_packed_rows_hold_every_document_without_loss(spark):
    rng = random.Random(4)
    texts = [None, "", "one", "  two  spaces ", "word " * 3000, "x" * 9000] + [
        " ".join(rng.choice(["la", "maison", "est"]) for _ in range(rng.randint(0, 80))) for _ in range(60)
    ]
    rows = [(i if i != 9 else None, t, "a") for i, t in enumerate(texts)] + [(3, texts[3], "a")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, pack_id string").repartition(3)
    packed = packing.pack_tokens(df, length=64, block_tokens=500).cache()
    ids = [r.pack_id for r in packed.collect()]
    assert len(ids) == len(set(ids))
    ranks = packing.read_ranks(open(packing.VOCABULARY, "rb").read())
    plain = tiktoken.Encoding("p", pat_str=packing.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in packed.collect():
        tokens, places = np.frombuffer(r.input_ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        assert len(tokens) == len(places) == 64 and r.cu_seqlens[-1] == r.n_tokens
        for a, b in zip(r.cu_seqlens, r.cu_seqlens[1:]):
            assert places[a:b].tolist() == list(range(b - a))
        assert (tokens[r.n_tokens :] == packing.EOS).all()
    got = {}
    for r in packing.unpacked(packed).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.ids))
    for i, t, _ in rows:
        whole = plain.encode_ordinary(t or "") + [packing.EOS]
        parts = sorted(got[i])
        if i == 3:
            parts = parts[::2]
        assert [x for _, p in parts for x in p] == whole
    assert packing.pack_tokens(df.limit(0)).count() == 0

import random
import zlib

import numpy as np
import pytest

from eventmart.llm import byte_cnn, masked_lm


def small(seed=0):
    rng = np.random.default_rng(seed)
    p = masked_lm.start(rng.integers(0, 50, masked_lm.SIZE).astype(float))
    return p, rng.integers(0, masked_lm.SIZE + 1, (40, 4)), rng.integers(0, masked_lm.SIZE, 40)


def test_conditional_probabilities_sum_to_one():
    p, context, _ = small()
    one = np.repeat(context[:1], masked_lm.SIZE, axis=0)
    assert np.exp(masked_lm.log_prob(p, one, np.arange(masked_lm.SIZE))).sum() == pytest.approx(1, abs=1e-4)


def test_lm_gradients_match_differences():
    p, context, target = small(1)
    p = {k: np.asarray(v, np.float64) for k, v in p.items()}
    _, dense, sparse = masked_lm.gradients(p, context, target)
    loss = lambda: masked_lm.gradients(p, context, target)[0]
    rng = random.Random(3)
    for name, grad in dense.items():
        flat = p[name].reshape(-1)
        hot = np.flatnonzero(np.abs(grad.reshape(-1)) > 1e-4)
        for i in rng.sample(list(hot), min(5, len(hot))):
            flat[i] += 1e-5
            up = loss()
            flat[i] -= 2e-5
            down = loss()
            flat[i] += 1e-5
            assert (up - down) / 2e-5 == pytest.approx(grad.reshape(-1)[i], rel=1e-3, abs=1e-6)
    for j, (ids, grad) in enumerate(sparse):
        k = int(np.abs(grad[:, 0]).argmax())
        p["T"][j, ids[k], 0] += 1e-5
        up = loss()
        p["T"][j, ids[k], 0] -= 2e-5
        assert (up - loss()) / 2e-5 == pytest.approx(grad[k, 0], rel=1e-3, abs=1e-6)
        p["T"][j, ids[k], 0] += 1e-5


def test_lm_scores(spark):
    rng = random.Random(7)
    say = lambda n: " ".join(f"{rng.choice('abcd')}1 x {rng.choice('abcd')}2" for _ in range(n))
    rows = [(i, say(40)) for i in range(300)] + [(900, None), (901, " \n"), (None, "one"), (902, "x " * 30_000), (903, say(3)), (903, say(3))]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, n_tokens int").repartition(3)
    model = masked_lm.fit(df)
    words = say(30).split()
    rng.shuffle(words)
    test = spark.createDataFrame([(1, say(30)), (2, " ".join(words)), (3, None), (4, "zz yy")], "doc_id bigint, text string")
    got = {r.doc_id: r for r in masked_lm.scored(test, model).collect()}
    assert got[1].mean_log_prob > got[2].mean_log_prob and (got[3].n_tokens, got[3].pseudo_log_likelihood, got[3].mean_log_prob) == (0, 0.0, None)
    ids = masked_lm.Ids(model[0])(test.first().text)
    padded = [masked_lm.PAD] * 2 + ids.tolist() + [masked_lm.PAD] * 2
    one_by_one = [
        masked_lm.log_prob(model[1], np.array([[padded[i], padded[i + 1], padded[i + 3], padded[i + 4]]]), np.array([padded[i + 2]]))[0]
        for i in range(len(ids))
    ]
    assert got[1].pseudo_log_likelihood == pytest.approx(sum(one_by_one), rel=1e-4)
    assert len(masked_lm.scored(df, model).collect()) == len(rows)
    empty = df.limit(0)
    assert masked_lm.scored(empty, masked_lm.fit(empty)).count() == 0


def test_rare_words_score_by_their_own_counts(spark):
    # Words of ids of their own, and then rare ones of two counts, of one hashed id.
    from xxhash import xxh64_intdigest

    often, once, never = [w for i in range(20_000) if xxh64_intdigest(w := f"rare{i}", 42) % masked_lm.BUCKETS == 7][:3]
    common = " ".join(f"w{i} w{i} w{i} w{i}" for i in range(masked_lm.TOP))
    rows = [(0, common), (1, common), (2, f"{often} {often} {once}"), (3, often)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = masked_lm.fit(df, rounds=1)
    test = spark.createDataFrame([(1, often), (2, once), (3, never), (4, f"{often} {often} w1"), (4, f"{never} {often} w1")], "doc_id bigint, text string")
    got = sorted((r.doc_id, r.pseudo_log_likelihood, r.n_tokens) for r in masked_lm.scored(test, model).collect())
    id_ = np.array([masked_lm.TOP + 7])
    net = masked_lm.log_prob(model[1], np.full((1, 4), masked_lm.PAD), id_)[0]
    assert model[3][7] == 4
    for (_, score, _), share in zip(got[:3], (3 / 5, 1 / 5, 1 / 5)):
        assert score == pytest.approx(net + np.log(share), abs=1e-5)
    assert len(got) == 5 and got[4][1] - got[3][1] == pytest.approx(np.log(3), abs=1e-5)
    assert masked_lm.scored(df, model).count() == len(rows)


def test_every_position_is_learnt_once(spark, monkeypatch):
    monkeypatch.setattr(masked_lm, "SHARE", 300)
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(n)) for n in (0, 1, 2, 5, 9, 40, 3000, *([60] * 40))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    words, _, _, _, known = masked_lm.vocabulary(df)
    shares, a_round = masked_lm.dealt(masked_lm.encoded(df, words, known), 3)
    rows = shares.collect()
    assert a_round == -(-sum(len(x.split()) for x in texts) // 900) and len(rows) == len(texts)
    assert {r.share % 3 for r in rows} == {0, 1, 2} and all(0 <= r.share < 3 * a_round for r in rows)
    # Every position of every row is a target, with its own neighbours.
    ids = [np.frombuffer(r.ids, "<u2").astype(np.int32) for r in rows]
    context, target = (np.concatenate(x) for x in zip(*masked_lm._minibatches(iter(ids))))
    assert target.tolist() == np.concatenate(ids).tolist()
    padded = [np.concatenate(([masked_lm.PAD] * 2, x, [masked_lm.PAD] * 2)) for x in ids]
    assert context.tolist() == [[p[i], p[i + 1], p[i + 3], p[i + 4]] for x, p in zip(ids, padded) for i in range(len(x))]


def test_scores_do_not_hang_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(masked_lm, "SHARE", 3000)
    rng = random.Random(9)
    rows = []
    for i in range(400):
        at, said = rng.randrange(12), []
        for _ in range(60):
            at = (at * 5 + 3) % 12 if rng.random() < 0.9 else rng.randrange(12)
            said.append(f"w{at}")
        rows.append((i, " ".join(said)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [{r.doc_id: r.mean_log_prob for r in masked_lm.fit_scored(df.repartition(n)).collect()} for n in (1, 64)]
    assert max(abs(got[0][i] - got[1][i]) for i in got[0]) < 1e-3
    assert np.mean(list(got[0].values())) > -2.3  # it has learnt something: a word by itself has -2.5


def test_frequent_words_come_by_a_threshold(spark):
    rows = [(f"a{i}", 5000 + i) for i in range(50)] + [(f"b{i}", 7) for i in range(300)] + [(f"c{i}", 1) for i in range(1000)]
    counted = spark.createDataFrame(rows, "word string, n bigint")
    for most, want in ((10, None), (49, None), (60, 50), (349, 50), (350, 350), (1349, 350), (1350, 1350)):
        n = masked_lm.frequent(counted, most).count()
        assert n <= most and (want is None or n == want)


def test_extreme_numbers_do_not_overflow():
    p, context, target = small(2)
    p["c"][:] *= 400
    want = masked_lm.log_prob({k: np.asarray(v, np.float64) for k, v in p.items()}, context, target)
    assert np.allclose(masked_lm.log_prob(p, context, target), want, rtol=1e-4) and np.isfinite(want).all()


def test_cnn_gradients_match_differences():
    rng = np.random.default_rng(2)
    p = {
        "T": rng.normal(0, 0.1, (byte_cnn.WIDTH, 256, byte_cnn.FILTERS)), "b": rng.normal(0, 0.1, byte_cnn.FILTERS),
        "w": rng.normal(0, 0.3, 3 * byte_cnn.FILTERS), "a": np.zeros(1),
    }
    p = {k: v.astype(np.float32) for k, v in p.items()}
    data = rng.integers(97, 105, 1500).astype(np.uint8)
    _, grad = byte_cnn.gradient(p, data, 1)
    loss = lambda: -np.log(byte_cnn.probability(p, data))
    for name in p:
        i = int(np.abs(grad[name]).argmax())
        flat = p[name].reshape(-1)
        flat[i] += 2e-3
        up = loss()
        flat[i] -= 4e-3
        assert (up - loss()) / 4e-3 == pytest.approx(grad[name].reshape(-1)[i], rel=0.05, abs=1e-4)
        flat[i] += 2e-3


def test_chunks_cover_the_whole_text():
    p = {"T": np.zeros((byte_cnn.WIDTH, 256, byte_cnn.FILTERS), np.float32)}
    p["T"][0, ord("#"), 0] = 1
    for n in (0, 1, 127, 128, 129, 255, 256, 70_000):
        for at in {0, n // 2, n - 1} - {-1}:
            if n:
                data = np.full(n, ord("a"), np.uint8)
                data[at] = ord("#")
                top, _, _ = byte_cnn.half_maxima(p, data)
                assert top[:, 0].max() == 1


def test_cnn_learns_what_labels_mark(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    good = lambda: " ".join(word() for _ in range(60)) + "."
    bad = lambda: " | ".join(word() for _ in range(60))
    rows = [(i, bad() if i % 4 == 0 else good()) for i in range(800)] + [(None, good()), (5000, None), (5001, ""), (5002, good() * 900)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id bigint, text string, quality int")
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(800)] + [(None, 1, 0), (7, None, 0), (9999, 1, 0)], "doc_id bigint, quality int, toxic int")
    p = byte_cnn.fitted(docs, labels)
    got = byte_cnn.scored(docs, p).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [r for r in got if r.held_out and r.doc_id < 800]
    assert sum(r.predicted != (r.doc_id % 4 != 0) for r in held) <= 0.02 * len(held)
    assert byte_cnn.scored(docs.limit(0), byte_cnn.fitted(docs, labels.limit(0))).count() == 0


def test_cnn_scores_match_plain_sums(spark):
    rng = np.random.default_rng(4)
    p = {
        "T": rng.normal(0, 0.2, (byte_cnn.WIDTH, 256, byte_cnn.FILTERS)), "b": rng.normal(0, 0.2, byte_cnn.FILTERS),
        "w": rng.normal(0, 0.3, 3 * byte_cnn.FILTERS), "a": rng.normal(0, 0.1, 1),
    }
    p = {k: v.astype(np.float32) for k, v in p.items()}
    say = lambda n: "".join(rng.choice(list("abc é\n日")) for _ in range(n))
    texts = [None, "", "x", *(say(n) for n in (5, 60, 127, 128, 129, 300, 2500)), "ab" * 9000, "\x00" * 400]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: r.score for r in byte_cnn.scored(docs, p).collect()}
    step = byte_cnn.CHUNK // 2
    for i, text in enumerate(texts):
        data = list((text or "").encode())
        chunks = max(2, -(-len(data) // step)) - 1
        data += [0] * ((chunks + 1) * step + byte_cnn.WIDTH - 1 - len(data))
        pooled = []
        for c in range(chunks):
            best = None
            for at in range(c * step, c * step + byte_cnn.CHUNK):
                said = sum(p["T"][k][data[at + k]].astype(float) for k in range(byte_cnn.WIDTH))
                best = said if best is None else np.maximum(best, said)
            pooled.append(np.maximum(best + p["b"], 0))
        pooled = np.array(pooled)
        x = [*pooled.mean(axis=0), *pooled.max(axis=0), *pooled.min(axis=0)]
        logit = sum(a * b for a, b in zip(x, p["w"].tolist())) + float(p["a"][0])
        assert got[i] == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-4)
    assert len(got) == len(texts)

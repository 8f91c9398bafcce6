import random
import re

from eventmart.llm import disclosure

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[^0-9]", "", m[0])
        double = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
        if 12 <= len(d) <= 19 and sum(x // 10 + x % 10 for x in double) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_base_spans_follow_the_patterns():
    rng = random.Random(8)
    parts = ["a.b", "@", "x", ".", "1", "255", "256", "4111 1111 1111 1111", "-", " ", "+", "+1 (620) 555-8424", "007", "é", "%", ".com", "0", "\n", ")"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert disclosure.base_spans(text) == brute(text), repr(text)
    for text in ("a" * 200_000, "9" * 100_000, "1." * 50_000, "+1" + "(" * 50_000, "a@" * 50_000):
        disclosure.base_spans(text)


def documents(spark):
    rng = random.Random(2)
    filler = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    noise = lambda n: " ".join(rng.choice(filler) for _ in range(n))
    rows = [(i, f"{noise(60)} reach the end.", "en") for i in range(400)]
    # The nickname stands beside one address only, and then alone in another document.
    rows += [(1000 + i, f"{noise(20)} {i} Zorblax, reach z.orb@example.com the {noise(20)}", "en") for i in range(6)]
    rows += [(1100, f"{noise(20)} (Zorblax) {noise(5)}", "en"), (1101, None, None), (1102, "", ""), (None, "x@y.zz", "en")]
    rows += [(1200, f"quendor 10.0.0.1 {noise(9)}", "en")] * 5  # one text many times: no support
    return spark.createDataFrame(rows, "doc_id bigint, text string, terms string"), rows


def test_terms_that_reveal_an_entity_are_found_everywhere(spark):
    df, rows = documents(spark)
    terms = {r.term: r for r in disclosure.disclosing_terms(df).collect()}
    assert "zorblax" in terms and "quendor" not in terms and "wordaa" not in terms and "the" not in terms
    assert abs(terms["zorblax"].share - 6 / 7) < 1e-9 and terms["zorblax"].removed
    found = disclosure.spans_of(df).collect()
    assert len(found) == len(rows)
    texts = dict((i, t) for i, t, _ in rows)
    for r in found:
        text = texts[r.doc_id] or ""
        assert [tuple(s) for s in r.base] == brute(text)
        for s in r.terms:
            assert text[s.start : s.end].lower() in terms
    alone = [r for r in found if r.doc_id == 1100][0]
    assert [texts[1100][s.start : s.end] for s in alone.terms] == ["Zorblax"]


def test_sanitised_text(spark):
    df, rows = documents(spark)
    out = disclosure.sanitised(df)
    assert out.columns == df.columns
    got = out.collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r.text for r in got}
    assert by_id[None] == "[EMAIL]" and by_id[1101] is None and by_id[1102] == ""
    assert "orblax" not in by_id[1100] and "z.orb" not in by_id[1003] and "[EMAIL]" in by_id[1003]
    assert by_id[5] == rows[5][1]
    assert disclosure.sanitised(df.limit(0)).count() == 0


def test_terms_of_rare_entities(spark):
    rows = [(i, f"some plain words of text number{i} go on.") for i in range(200)]
    rows += [
        (300, "ask Qworple at q.w@example.com for it"), (301, "ask Vandrix at v+home@example.com soon"), (302, "or Vandrix at V+work@example.com now"),
        (303, "Mumblex 10.0.0.9 is up"), (304, "and Mumblex is down"), (305, "Mumblex again"),
        (306, "then (Vandrix) left"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    terms = {r.term: r for r in disclosure.disclosing_terms(df).collect()}
    assert not terms["qworple"].removed and abs(terms["qworple"].share - (1 + 0.5 / 207) / 1.5) < 1e-9
    assert abs(terms["vandrix"].share - (2 + 0.5 * 2 / 207) / 3.5) < 1e-9  # two variants of one mailbox, three documents
    assert "mumblex" not in terms
    out = {r.doc_id: r.text for r in disclosure.sanitised(df).collect()}
    assert "[TERM]" in out[300] and "Qworple" not in out[300] and out[306] == "then ([TERM]) left" and "Mumblex" in out[304] and out[5] == rows[5][1]


def test_terms_are_found_between_blanks_of_any_kind(spark):
    blanks = [" ", "\u00a0", "\u3000", "\u0085", "\u001c", "\n", "\u2003"]
    rows = [(i, f"text {i} says{b}Zorblax{b}zor@mail.example{b}here {'word' + str(i)} again") for i, b in enumerate(blanks)]
    rows += [(100 + i, f"much later{b}Zorblax{b}alone {i}") for i, b in enumerate(blanks)]
    rows += [(1000 + i, f"says here again later alone much text {i} {i * 7}") for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in disclosure.spans_of(df).collect()}
    for doc, text in rows:
        spans = [text[s["start"] : s["end"]] for s in got[doc].terms]
        assert ("Zorblax" in spans) == ("Zorblax" in text), text
    hidden = {r.doc_id: r.text for r in disclosure.sanitised(df).collect()}
    assert not any("Zorblax" in t or "zor@" in t for t in hidden.values())


def test_shares_match_brute_force(spark):
    """P(entity | term) and disclosure of every disclosing term, recomputed pair by pair."""
    import math
    import random

    rng = random.Random(8)
    words = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)]
    boxes = [f"box{i}@mail.example" for i in range(12)]
    texts = []
    for i in range(300):
        own = rng.sample(words, 12)
        if i % 4 == 0:
            own.insert(rng.randrange(13), rng.choice(boxes))
        texts.append(rng.choice([" ", "\u00a0", "\u3000"]).join(own))
    texts += texts[:20]
    tokens = [t.split() for t in texts]
    beside, n_entity, n_term = {}, {}, {}
    for text, own in zip(texts, tokens):
        for t in {w for w in own if "@" not in w}:
            n_term[t] = n_term.get(t, 0) + 1
        for at, w in enumerate(own):
            if "@" in w:
                n_entity[w] = n_entity.get(w, 0) + 1
                for t in set(own[max(0, at - disclosure.REACH) : at] + own[at + 1 : at + 1 + disclosure.REACH]):
                    beside.setdefault((w, t), []).append(text)
    want = {}
    for (e, t), found in beside.items():
        d, s, prior = len(found), len(set(found)), n_entity[e] / len(texts)
        share = plain = min(1.0, d / n_term[t])
        if s < disclosure.SUPPORT:
            w = disclosure.PRIOR * d / s
            share = (s + w * prior) / (s / plain + w)
        bits = math.log2(share / prior)
        if share >= disclosure.GENERALISE and bits >= disclosure.LEAST_BITS:
            want[t] = (max(share, want.get(t, (0, 0))[0]), max(bits, want.get(t, (0, 0))[1]))
    got = {r.term: (r.share, r.bits) for r in disclosure.disclosing_terms(spark.createDataFrame([(t,) for t in texts], "text string")).collect()}
    assert set(got) == set(want)
    assert all(abs(got[t][k] - want[t][k]) < 1e-9 for t in got for k in (0, 1))

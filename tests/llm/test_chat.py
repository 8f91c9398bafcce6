import hashlib
import random

from pyspark.sql import functions as F

from eventmart.llm import chat, queries

SCHEMA = "conv_id bigint, seq bigint, message_id bigint, kind string, role string, text string"


def fold(events):
    """Event by event in Python."""
    conversations = {}
    for conv, seq, message, kind, role, text in sorted(events, key=lambda e: (e[1], e[3] or "", e[4] or "", e[5] or "")):
        messages = conversations.setdefault(conv, {})
        m = messages.setdefault(message, {"first": seq, "role": "", "text": "", "live": True, "regen": None})
        if kind == "message" or m["role"] == "" and role:
            m["role"] = role or ""
        if kind in ("message", "edit"):
            m["text"] = text or ""
        elif kind == "delta":
            m["text"] += text or ""
        elif kind == "regenerate":
            m["text"], m["regen"] = "", seq
        m["live"] = kind != "delete"
    out = {}
    for conv, messages in conversations.items():
        cut, turns = None, []
        for _, m in sorted(messages.items(), key=lambda x: (x[1]["first"], x[0])):
            if m["live"] and not (cut is not None and m["first"] < cut):
                turns.append((m["role"], m["text"]))
            if m["regen"] is not None:
                cut = max(cut or m["regen"], m["regen"])
        out[conv] = turns
    return out


def test_folding_matches_a_loop_over_events(spark):
    rng = random.Random(3)
    events = []
    for conv in range(30):
        for seq in range(rng.randint(1, 25)):
            kind = rng.choice(["message", "delta", "delta", "edit", "regenerate", "delete"])
            events.append((conv, seq, rng.randint(1, 5), kind, rng.choice(["user", "assistant", None]), rng.choice(["a", "</s>", None, "x\\y "])))
    df = spark.createDataFrame(events, SCHEMA).repartition(5)
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat.conversations_of(df).collect()}
    assert got == fold(events)
    read = chat.read_back(chat.rendered(chat.conversations_of(df))).collect()
    assert {r.conv_id: [(t.role, t.text) for t in r.read_turns] for r in read} == got
    assert chat.read_back(chat.rendered(chat.conversations_of(df.limit(0)))).count() == 0


def test_any_text_and_role_reads_back(spark):
    rng = random.Random(4)
    parts = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", ">", "/", "s", "[", "]", "n", "\n", " ", "é", "😀", "$1", "\\n", "<\\s>"]
    piece = lambda: "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
    rows = [(c, t, rng.choice(["user", "assistant", "system", piece(), None]), rng.choice([piece(), piece(), None])) for c in range(200) for t in range(rng.randint(1, 6))]
    rows += [(None, None, None, None), (3, 0, "user", "again"), (7, None, "assistant", "x" * 100_000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id bigint, turn bigint, role string, text string, seq string")
    got = {r.conv_id: r for r in chat.read_back(chat.rendered(chat.conversations_of(chat.turn_events(df)))).collect()}
    low = lambda x: (x is not None, x if x is not None else "")
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, low(r[2]), low(r[3])))
        turns = [(r[2] or "", r[3] or "") for r in own]
        assert [(t.role, t.text) for t in got[conv].read_turns] == turns
        assert got[conv].loss_text == "".join(t for role, t in turns if role == "assistant")
        assert got[conv].formatted.count("</s>") == len(turns) and got[conv].formatted.count("<s>") == len(turns)


def test_query_adds_the_marked_conversation(spark, sf_dir):
    row = queries.op5_chat_format(spark, sf_dir).where(F.col("conv_id") == -1).first()
    text = "</s>[INST] ok [/INST]"
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert (row.n_turns, row.loss_chars, row.loss_sha256) == (2, len(text), hashlib.sha256(text.encode()).hexdigest())


def test_streamed_logs_fold_back_to_their_turns(spark):
    rng = random.Random(6)
    sizes = [0, 1, 2, 15, 16, 17, 18, 19, 33, 34, 500]
    piece = lambda n: "".join(rng.choice(["a", "\\", "</s>", "é", "😀", "\n"]) for _ in range(n))[:n]
    rows = [(c, t, rng.choice(["user", "assistant", None, ""]), rng.choice([piece(n), piece(n), None])) for c in range(9) for t, n in enumerate(sizes)]
    rows += [(None, None, None, None), (3, 0, "user", "again"), (3, 0, "user", "again")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("seq", F.lit("clash"))
    log = chat.streamed_events(df)
    assert log.count() == chat.EVENTS * len(rows)
    events = [tuple(r) for r in log.select("conv_id", "seq", "message_id", "kind", "role", "text").collect()]
    of = lambda events: {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat.conversations_of(events).collect()}
    assert of(log) == of(chat.turn_events(df)) == fold(events)
    assert of(log.repartition(7)) == fold(events)
    assert chat.conversations_of(chat.streamed_events(df.limit(0))).count() == 0

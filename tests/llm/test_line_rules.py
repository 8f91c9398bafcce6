import random
import re
from collections import Counter

from eventmart.llm import line_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered))


def texts():
    rng = random.Random(2)
    out = [None, "", " \n\t ", "one", "a b", "a b c", "a a a a", "\n\n", "x " * 60, "é b c\x0bd\x0ce", "ab|cd <x>\r\nab|cd <x>\r\n"]
    for _ in range(150):
        out.append("".join(rng.choice(["la ", "le ", "un\n", "de\t", "que. ", "|", "# ", "\n"]) for _ in range(rng.randint(0, 90))))
    prose = lambda n: "\n".join(" ".join(f"w{rng.randrange(10**6)}" for _ in range(12)) + "." for _ in range(n))
    return out + [prose(9), prose(9), prose(9) + "\n" + prose(9), prose(4000), " ".join(f"w{i % 5000}" for i in range(30_000))]


def test_counts_match_brute_force(spark):
    all_texts = texts()
    rows = [(i, t, "s", 1) for i, t in enumerate(all_texts)] + [(None, all_texts[11], "s", 1), (3, "one", "s", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_words string, _lr_x int")
    got = line_rules.judged(df.repartition(3)).collect()
    assert len(got) == len(rows)
    want = {i: brute(t) for i, t, *_ in rows}
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want[r.doc_id], r.doc_id
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_lines_are_judged_first_and_clean_documents_stay_as_they_are(spark):
    line = lambda i: " ".join(f"word{i * 20 + k}" for k in range(15)) + "."
    clean = "\n".join(line(i) for i in range(8))
    mixed = clean + "\nHome | About | Contact | Login\nAll rights reserved.\nno end of a sentence here"
    junk = " | ".join(f"item{i}" for i in range(80))
    hung = " ".join(f"item{i}###" for i in range(80)) + "."
    df = spark.createDataFrame([(1, clean, len(clean)), (2, mixed, 0), (3, junk, 0), (4, hung, 0), (5, None, 0)], "doc_id bigint, text string, n_chars bigint")
    got = {r.doc_id: r for r in line_rules.cleaned(df).collect()}
    assert set(got) == {1, 2} and got[1].text == got[2].text == clean and got[2].n_chars == len(clean)
    seen = {r.doc_id: r for r in line_rules.judged(df).collect()}
    assert (seen[2].n_navigation, seen[2].n_boilerplate, seen[2].n_punctuation) == (1, 1, 1)
    assert line_rules.cleaned(df.limit(0)).count() == 0 and line_rules.cleaned(df).columns == df.columns


def test_equal_hashes_of_unlike_windows_are_no_repeat(spark, monkeypatch):
    from pyspark.sql import functions as F

    whole = line_rules.window_hashes
    monkeypatch.setattr(line_rules, "window_hashes", lambda words, n: F.transform(whole(words, n), lambda h: F.pmod(h, F.lit(3))))
    all_texts = [t for t in texts() if len(t or "") < 3000]
    df = spark.createDataFrame(list(enumerate(all_texts)), "doc_id bigint, text string")
    for r in line_rules.judged(df).collect():
        assert r.n_repeat_words == brute(all_texts[r.doc_id])[4], r.doc_id


def test_long_lines_are_judged_by_their_finished_sentences(spark):
    told = " ".join(" ".join(f"w{i}x{k}" for k in range(9)) + "." for i in range(30))
    hindi = " ".join(" ".join(f"क{i}x{k}" for k in range(9)) + "।" for i in range(10))
    rows = [(1, told + " and one more without an end"), (2, "x. " + told.replace(".", "")), (3, "short line without an end"), (4, hindi)]
    got = {r.doc_id: r for r in line_rules.judged(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [got[i].n_punctuation for i in (1, 2, 3, 4)] == [0, 1, 1, 0]
    assert got[1].kept and not got[2].kept and got[4].kept


def test_names_of_the_counts_are_free_for_columns(spark):
    text = "\n".join(" ".join(f"w{i}x{k}" for k in range(9)) + "." for i in range(9))
    df = spark.createDataFrame([(1, text, -5, "a", "b", "c", 0)], "doc_id bigint, text string, n_words int, KEPT string, _lr_text string, held string, n_chars bigint")
    row = line_rules.cleaned(df).first()
    assert tuple(row) == (1, text, -5, "a", "b", "c", len(text)) and line_rules.cleaned(df).columns == df.columns
    from eventmart.llm import disclosure, mixing

    odd = df.select("doc_id", "text", F_lit("s").alias("source"), F_lit(7).alias("uid"), F_lit(8).alias("copies"), F_lit(9).alias("new"), F_lit(1).alias("no"))
    assert {tuple(r)[3:] for r in mixing.mixed_documents(odd).collect()} == {(7, 8, 9, 1)}
    assert tuple(disclosure.sanitised(odd).first()) == (1, text, "s", 7, 8, 9, 1)


def F_lit(x):
    from pyspark.sql import functions as F

    return F.lit(x)

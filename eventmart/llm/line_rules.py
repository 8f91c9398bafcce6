"""Line-first cleaning: drop lines that break a rule, then reject documents that lose too much.

Every line with a word is judged alone by three rules:

- navigation: separators (`|`, `>`, `»`, `•`, `·`) stand between most of its words;
- boilerplate: a short line that holds a stock phrase (licence, cookie, login lines);
- punctuation: it lacks a sentence end, or symbols or doubled marks hang on its words.

Failing lines go; a document that lost more than `max_lost` of its word characters
is rejected, and so is one under `min_words` or with more than `max_repeat` of its
words in three-word windows found twice. All of it is column expressions: no
Python in the tasks, no shuffle, and one document's work is linear in its length
but for two sorts of its windows.

Edge cases: null text counts as empty (no words, so rejected); a text without
line breaks is one line; blank lines are kept and never counted; repeated rows
are judged each; a null id is passed on; other columns never enter.

Windows are sorted by their XXH64 and then by their words, so equal hashes of unlike
windows do not count as a repeat. A line over `LONG_LINE` characters that lacks a sentence end at its last
character breaks the rule only if less than half of it lies in finished sentences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.text import SPACE, split_words, text_or_empty

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST_PERCENT = 50
BOILERPLATE_CHARS = 300
#: A separator or hung mark for so many characters of a line, or more, makes the rule.
CHARS_PER_MARK = 24

SYMBOLS = "#*$%&|<>"
#: Any character that the counts of symbols, the navigation or the hung-mark rule look for.
MARKS = r"[|>»•·!?#*$%&<]"
SEPARATOR = r"(^|[\x20\x09-\x0D])[|>»•·]($|[\x20\x09-\x0D])"
#: Marks that end a sentence, of several scripts.
ENDS = "[.!?…:;。！？।॥؟۔]"
SENTENCE_END = ENDS + r"[\"'”’»)\]]*[\x20\x09-\x0D]*$"
#: All that a line holds up to the end of its last finished sentence.
FINISHED = r"(?s)^.*" + ENDS + r"[\"'”’»)\]]*[\x20\x09-\x0D]"
LONG_LINE = 300
#: A word that ends in two or more marks, or in a symbol.
HUNG_WORD = r"([!?#*$%&<>]{2,}[.,]*|[#*$%&<>])($|[\x20\x09-\x0D])"
#: Phrases of stock lines, matched in lower case.
STOCK = (
    "all rights reserved", "licensed under", "terms of use", "terms of service", "privacy policy", "cookie",
    "enable javascript", "click here", "sign up", "log in to", "login to", "subscribe to", "powered by",
    "copyright ©", "copyright (c)",
)

KEPT, NAVIGATION, STOCK_LINE, PUNCTUATION = 0, 1, 2, 3


def has_stock(text: Column) -> Column:
    low = F.lower(text)
    found = F.contains(low, F.lit(STOCK[0]))
    for phrase in STOCK[1:]:
        found = found | F.contains(low, F.lit(phrase))
    return found


def _dense(line: Column, pattern: str) -> Column:
    """The pattern is found, and often for the line's length."""
    return line.rlike(pattern) & ((F.size(F.split(line, pattern)) - 1) * CHARS_PER_MARK >= F.length(line))


def line_fault(line: Column, marked: Column, stock: Column) -> Column:
    """0 for a line to keep, else the first rule it breaks.

    `marked` and `stock` say of the whole document whether such rules can apply at all.
    """
    return (
        F.when(~line.rlike(r"[^\x20\x09-\x0D]"), F.lit(KEPT))
        .when(marked & _dense(line, SEPARATOR), F.lit(NAVIGATION))
        .when(stock & (F.length(line) <= BOILERPLATE_CHARS) & has_stock(line), F.lit(STOCK_LINE))
        .when(marked & _dense(line, HUNG_WORD), F.lit(PUNCTUATION))
        .when(line.rlike(SENTENCE_END), F.lit(KEPT))
        .when((F.length(line) > LONG_LINE) & (2 * F.length(F.regexp_extract(line, FINISHED, 0)) >= F.length(line)), F.lit(KEPT))
        .otherwise(F.lit(PUNCTUATION))
    )


def window_hashes(words: Column, n: Column) -> Column:
    """XXH64 of every three-word window; `words` must be a plain reference."""
    first = F.slice(words, F.lit(1), F.greatest(n - 2, F.lit(0)))
    return F.transform(first, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))


def placed(hashes: Column, words: Column) -> Column:
    """Each window with its hash and place, sorted: equal windows come together."""

    def one(h, i):
        return F.struct(h.alias("h"), F.get(words, i).alias("a"), F.get(words, i + 1).alias("b"), F.get(words, i + 2).alias("c"), i.cast("long").alias("i"))

    return F.sort_array(F.transform(hashes, one))


def same_window(x: Column, y: Column) -> Column:
    equal = x["h"] == y["h"]
    for part in "abc":
        equal = equal & (x[part] == y[part])
    return F.coalesce(equal, F.lit(False))


def judged(df: DataFrame, text: str = "text", max_lost: int = MAX_LOST_PERCENT) -> DataFrame:
    """Each row with its counts, rule verdicts and cleaned text, beside all of its own columns.

    Adds `n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines,
    n_navigation, n_boilerplate, n_punctuation, lost_chars, clean_text, base_failed,
    kept`; columns of these names in the input are overwritten. Work columns are
    prefixed `_lr_`.
    """
    base = df.withColumn("_lr_text", text_or_empty(df, text))
    body = F.col("_lr_text")
    base = base.withColumns(
        {
            "_lr_words": split_words(body),
            "_lr_lines": F.split(body, "\n", -1),
            "_lr_marked": body.rlike(MARKS),
            "_lr_stock": has_stock(body),
        }
    )
    words, lines, marked = F.col("_lr_words"), F.col("_lr_lines"), F.col("_lr_marked")
    base = base.withColumns(
        {
            "_lr_n": F.size("_lr_words"),
            "_lr_full": F.filter("_lr_lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
            "_lr_fault": F.transform("_lr_lines", lambda x: line_fault(x, marked, F.col("_lr_stock"))),
            "_lr_hash": window_hashes(words, F.size("_lr_words")),
        }
    )
    n, fault, hashes = F.col("_lr_n"), F.col("_lr_fault"), F.col("_lr_hash")
    # Most texts repeat no window; only the others are sorted.
    repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)
    base = base.withColumn("_lr_hash", F.when(repeats, hashes))
    base = base.withColumn("_lr_win", F.when(hashes.isNotNull(), placed(hashes, words)))
    win = F.col("_lr_win")
    twice = F.filter(win, lambda x, i: same_window(x, F.get(win, i + 1)) | ((i > 0) & same_window(x, F.get(win, i - 1))))
    base = base.withColumn("_lr_at", F.sort_array(F.transform(twice, lambda x: x["i"])))
    at, three, none = F.col("_lr_at"), F.lit(3).cast("long"), F.lit(0).cast("long")
    steps = F.transform(at, lambda p, i: F.least(three, F.coalesce(F.get(at, i + 1) - p, three)))
    repeat = F.coalesce(F.aggregate(steps, none, lambda a, x: a + x), none)

    def faults(kind):
        return F.size(F.filter(fault, lambda x: x == kind)).cast("long")

    base = base.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": F.length(F.array_join(words, "")).cast("long"),
            "n_symbols": F.when(marked, F.length(F.regexp_replace(body, f"[^{SYMBOLS}]+", "")).cast("long")).otherwise(none),
            "n_dup_lines": (F.size("_lr_full") - F.size(F.array_distinct("_lr_full"))).cast("long"),
            "n_repeat_words": repeat,
            "n_lines": F.size("_lr_full").cast("long"),
            "n_navigation": faults(NAVIGATION),
            "n_boilerplate": faults(STOCK_LINE),
            "n_punctuation": faults(PUNCTUATION),
            "_lr_clean": F.forall(fault, lambda x: x == KEPT),
            "_lr_good": F.filter(lines, lambda x, i: F.get(fault, i) == KEPT),
        }
    )
    clean = F.col("_lr_clean")
    kept_chars = F.length(F.regexp_replace(F.array_join("_lr_good", ""), SPACE + "+", "")).cast("long")
    base = base.withColumns(
        {
            "lost_chars": F.when(clean, none).otherwise(F.col("word_chars") - kept_chars),
            "clean_text": F.when(clean, body).otherwise(F.array_join("_lr_good", "\n")),
            "base_failed": (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT),
        }
    )
    # The row number (never negative) keeps the optimizer from moving a filter on the verdict below the
    # columns above, which would then be worked out anew for each element that refers to them.
    fair = ~F.col("base_failed") & (F.col("lost_chars") * 100 <= F.col("word_chars") * max_lost)
    base = base.withColumn("kept", fair & (F.monotonically_increasing_id() >= 0))
    return base.drop(*[c for c in base.columns if c.startswith("_lr_")])


def cleaned(df: DataFrame, max_lost: int = MAX_LOST_PERCENT) -> DataFrame:
    """The kept documents, their failing lines removed and `n_chars` set anew where there is one."""
    # The input travels as one column, so none of its names can meet one of the counts.
    held = df.select(F.struct(*[df[c] for c in df.columns]).alias("held"), df["text"])
    out = judged(held, max_lost=max_lost).where("kept")
    own = {c: F.col("held").getField(c) for c in df.columns}
    own["text"] = F.col("clean_text").cast(df.schema["text"].dataType)
    if "n_chars" in own:
        own["n_chars"] = F.length("clean_text").cast(df.schema["n_chars"].dataType)
    return out.select(*[own[c].alias(c) for c in df.columns])

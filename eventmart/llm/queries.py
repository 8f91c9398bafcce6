"""The registered queries of this subpackage, each over its whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm import (
    byte_cnn,
    chat,
    disclosure,
    lexical_search,
    line_rules,
    masked_lm,
    minhash,
    mixing,
    packing,
    prefix_trie,
    simhash,
    substrings,
    templates,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLE[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


OP5_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
  SELECT *, replace(replace(replace(replace(replace(text, '\', '\\'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]') AS safe,
    replace(replace(replace(replace(replace(replace(role, '\', '\\'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]'), chr(10), '\n') AS safe_role
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(safe_role) + length(safe) + 8 + CASE WHEN role = 'assistant' THEN 0 ELSE 15 END) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


@query(OP5_SQL)
def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and -1, as a log of drafts, deltas, edits and regenerations, folded, through the template and back."""
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", marks), (-1, 1, "assistant", marks)], told.schema)
    done = chat.read_back(chat.rendered(chat.conversations_of(chat.streamed_events(told.unionByName(own)))))
    lines = F.transform("read_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return done.select(
        "conv_id",
        F.size("read_turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    string_split(text, chr(10)) AS lines FROM d
), grams AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 1))) AS i FROM w)
), twice AS (
  SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id
), lines AS (
  SELECT doc_id, unnest(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) AS line FROM w
), marks AS (
  SELECT doc_id, line, length(line) AS n, length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
    regexp_matches(line, '(^|[\x20\x09-\x0D])[|>»•·]($|[\x20\x09-\x0D])') AS nav,
    len(regexp_split_to_array(line, '(^|[\x20\x09-\x0D])[|>»•·]($|[\x20\x09-\x0D])')) - 1 AS navs,
    regexp_matches(line, '([!?#*$%&<>]{2,}[.,]*|[#*$%&<>])($|[\x20\x09-\x0D])') AS hung,
    len(regexp_split_to_array(line, '([!?#*$%&<>]{2,}[.,]*|[#*$%&<>])($|[\x20\x09-\x0D])')) - 1 AS hungs
  FROM lines
), faults AS (
  SELECT doc_id, chars, line,
    CASE WHEN nav AND navs * 24 >= n THEN 1
         WHEN n <= 300 AND regexp_matches(lower(line), '(all rights reserved|licensed under|terms of use|terms of service|privacy policy|cookie|enable javascript|click here|sign up|log in to|login to|subscribe to|powered by|copyright ©|copyright \(c\))') THEN 2
         WHEN hung AND hungs * 24 >= n THEN 3
         WHEN NOT regexp_matches(line, '[.!?…:;。！？।॥؟۔]["''”’»)\]]*[\x20\x09-\x0D]*$')
           AND NOT (n > 300 AND 2 * length(regexp_extract(line, '(?s)^.*[.!?…:;。！？।॥؟۔]["''”’»)\]]*[\x20\x09-\x0D]')) >= n) THEN 3
         ELSE 0 END AS fault FROM marks
), lost AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines, sum(chars) AS word_chars,
    coalesce(sum(chars) FILTER (fault > 0), 0) AS lost FROM faults GROUP BY doc_id
), base AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    coalesce(lost, 0) AS lost
  FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN lost USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed,
  NOT (n_words < 50 OR n_repeat_words * 100 > n_words * 50) AND lost * 100 <= word_chars * 50 AS kept
FROM base
"""


@query(OP10_SQL)
def op10_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_rules.judged(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query()
def op3_packed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as packed token rows."""
    return packing.pack_tokens(table(spark, sf_dir, "documents"))


@query()
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    named = simhash.classes(table(spark, sf_dir, "documents"))
    return named.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query()
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    return mixing.decisions(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query()
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item."""
    return templates.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op7_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base spans, and those of terms that disclose it."""
    found = disclosure.spans_of(table(spark, sf_dir, "documents"))
    names = F.array(*[F.lit(k) for k in disclosure.KINDS])

    def told(spans):
        parts = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
        return F.array_join(parts, ",")

    def of_kind(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    plain = F.transform("terms", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return found.select(
        "doc_id",
        *[of_kind(i).alias(f"n_{k}") for i, k in enumerate(disclosure.KINDS[:4])],
        F.sha2(told("base"), 256).alias("base_sha256"),
        told(F.sort_array(F.concat("base", plain))).alias("spans"),
        F.size("terms").cast("long").alias("n_term"),
    )


@query()
def op1_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-log-likelihood of every document under the network trained on all of them."""
    return masked_lm.fit_scored(table(spark, sf_dir, "documents"))


@query()
def op2_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    return byte_cnn.scored(docs, byte_cnn.fitted(docs, table(spark, sf_dir, "labels")))


@query()
def op8_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of strings of 200 bytes that stand elsewhere too."""
    kept = substrings.deduplicated(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of corpus_pipeline.py."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), t AS (
  SELECT r, any_value(doc_id) AS doc_id, term, count(*) AS tf, any_value(n) AS n
  FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY r, term
), totals AS (
  SELECT count(*) AS docs, CAST(sum(len(terms)) AS BIGINT) AS words FROM d WHERE len(terms) > 0
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM t, totals GROUP BY term
), q AS (
  SELECT row_number() OVER () AS i, item_id, list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS terms FROM benchmark
), s AS (
  SELECT i, any_value(item_id) AS item_id, r, any_value(doc_id) AS doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words)))) AS BIGINT) AS score
  FROM (SELECT i, item_id, unnest(terms) AS term FROM q) JOIN w USING (term) JOIN t USING (term), totals GROUP BY i, r
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10
"""


@query(OP11_SQL)
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH told AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text)) AS turns,
    list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda a, b: list_reduce(list_prepend(xor(a, b), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]),
        lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END)) AS crc
  FROM told GROUP BY conv_id
), rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.turns, [])[1:xor(o.crc, CAST(4294967295 AS BIGINT)) % 6], o.turns[xor(o.crc, CAST(4294967295 AS BIGINT)) % 6 + 1:]) AS turns
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100
), path AS (
  SELECT conv_id, turns[1:d] AS p, d, len(turns) AS n FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
), node AS (
  SELECT p, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
  FROM path GROUP BY p
), linked AS (
  SELECT x.*, up.conv_id AS parent_conv_id, coalesce(k.n, 0) AS n_children
  FROM node x LEFT JOIN node up ON x.depth > 0 AND up.p = x.p[1:x.depth - 1]
  LEFT JOIN (SELECT p[1:depth - 1] AS p, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1) k ON k.p = x.p
), below AS (
  SELECT p[1:d] AS p, CAST(sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
    CAST(sum((n_convs - 1) * coalesce(length(p[depth].text), 0)) AS BIGINT) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM linked) GROUP BY 1
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 FROM linked JOIN below USING (p)
"""


@query(OP13_SQL)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all conversations, each opening as its group's first one."""
    lists = prefix_trie.turn_lists(table(spark, sf_dir, "conversations"))
    return prefix_trie.nodes(prefix_trie.shared_openings(lists))


OP12_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g FROM d
), t AS (
  SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s
), l AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM t a JOIN t b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))
), r AS (
  SELECT doc_id AS u, doc_id AS v FROM s UNION SELECT r.u, l.v FROM r JOIN l ON r.v = l.u
), c AS (
  SELECT u AS doc_id, min(v) AS component_id FROM r GROUP BY u
)
SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN c USING (doc_id)
"""


@query(OP12_SQL)
def op12_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and near-duplicate component of every document."""
    return minhash.classes(table(spark, sf_dir, "documents"))

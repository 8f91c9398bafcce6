"""Mixing sources to target weights by pivotal dependent rounding over a reduction tree.

Targets: sources in code point order, null last, weigh 5, 2, 1 repeating and share 150 % of
all words; none goes over `cap` = 2 times its source's words, the excess being reshared
by weight. A document's wanted copies are its source's target over its size: a whole
part all of its documents get, and a fraction that is rounded.

Rounding is pivotal: two fractions meet and words move from one to the other, up or down
by chance in the proportion that keeps both expectations, until one is 0 or 1; the other
goes on to the next. Words are conserved in each meeting, so a source ends within one
document of its target. Groups are hashed buckets of one source; each streams through
a task in constant memory and leaves one residual fraction, and the residuals of `FAN` groups
meet one level up until each source has one, which a last coin settles. A hot source is
many buckets.

Chance comes from a hash of seed, level, source and bucket over rows in a fixed order, so
reruns agree whatever the partitioning.

Edge cases: null text has size 0; documents of size 0 carry no words and are given their
whole part only; a null source is a source; repeated rows are rounded each; a corpus
without words has targets of 0; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventmart.llm.text import count_words, free_name, keep_columns, text_or_empty
from eventmart.session import stage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
BUCKET_ROWS = 4096
FAN = 64
EPS = 1e-9


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """`source, rank, source_size, n_docs, target`, ranked in code point order without a global sort in one task."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    laid = per.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    laid = stage(laid)
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    # One row per partition: the rows that come before it.
    parts = laid.groupBy("part").agg(F.count("*").alias("held"))
    before = parts.select("part", (F.sum("held").over(Window.orderBy("part")) - F.col("held")).alias("before"))
    ranked = laid.join(before, "part").withColumn("rank", F.col("before") + inside - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    ranked = stage(
        ranked.select("source", "rank", "source_size", "n_docs", weight.alias("weight"), (F.col("source_size") * cap).alias("most"))
    )
    total, all_weight = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    wanted = share * (total or 0)
    level, closed = (wanted / all_weight if all_weight else 0.0), -1
    # The level only rises, and each pass closes a source at least or ends.
    while True:
        row = ranked.agg(
            F.count_if(F.col("most") <= F.col("weight") * level),
            F.coalesce(F.sum(F.when(F.col("most") <= F.col("weight") * level, F.col("most"))), F.lit(0)),
            F.coalesce(F.sum(F.when(F.col("most") > F.col("weight") * level, F.col("weight"))), F.lit(0.0)),
        ).first()
        if row[0] == closed or not row[2]:
            break
        closed, level = row[0], (wanted - row[1]) / row[2]
    target = F.least(F.col("most").cast("double"), F.col("weight") * F.lit(float(level)))
    return ranked.select("source", "rank", "source_size", "n_docs", target.alias("target"))


def meet(p: float, s: int, q: float, t: int, u: float) -> tuple[float, float]:
    """Move words between fractions `p` of `s` words and `q` of `t`, one of which becomes 0 or 1."""
    up, down = min((1 - p) * s, q * t), min(p * s, (1 - q) * t)
    if u * (up + down) < down:
        moved = up
    else:
        moved = -down
    p, q = p + moved / s, q - moved / t
    snap = lambda x: 0.0 if x < EPS else 1.0 if x > 1 - EPS else x
    return snap(p), snap(q)


COLUMNS = ("uid", "rank", "bucket", "size", "whole", "p", "settled", "ident")
SCHEMA = "uid bigint, rank bigint, bucket bigint, size bigint, whole bigint, p double, settled boolean, ident bigint"


def _round_groups(level: int, seed: int, last: bool):
    """A mapper over rows sorted by (rank, bucket, ident) that settles all fractions but one of each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rng, rest = None, None, None

        def close():
            if rest is None:
                return []
            uid, rank, bucket, size, whole, p, _, ident = rest
            if last:
                return [(uid, rank, bucket, size, whole, 1.0 if rng.random() < p else 0.0, True, ident)]
            return [(uid, rank, bucket, size, whole, p, False, ident)]

        for batch in batches:
            out = []
            for row in zip(*[batch.column(c).to_pylist() for c in COLUMNS]):
                if (row[1], row[2]) != group:
                    out += close()
                    group, rest = (row[1], row[2]), None
                    rng = random.Random(f"{seed}:{level}:{row[1]}:{row[2]}")
                uid, rank, bucket, size, whole, p, _, ident = row
                if rest is None:
                    rest = row
                    continue
                held, mine = meet(rest[5], rest[3], p, size, rng.random())
                rest, new = (*rest[:5], held, True, rest[7]), (uid, rank, bucket, size, whole, mine, True, ident)
                if held in (0.0, 1.0):
                    out.append(rest)
                    rest = new
                    if mine in (0.0, 1.0):
                        out.append(new)
                        rest = None
                else:
                    out.append(new)
            if out:
                yield _batch(out)
        if out := close():
            yield _batch(out)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.bool_(), pa.int64())
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], list(COLUMNS))


def mix(sizes: DataFrame, seed: int = 7, **targets) -> DataFrame:
    """`uid, size, source_size, target, copies` for rows `uid, ident, source, size`.

    `uid` is unique; `ident` says the same in every run and settles order and bucket.

    `sizes` should be stored rows: several passes read it.
    """
    known = source_targets(sizes, **targets)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    named = known.select(
        F.col("source").alias("of"),
        "rank",
        rate.alias("rate"),
        F.greatest(F.ceil(F.col("n_docs") / F.lit(BUCKET_ROWS)), F.lit(1)).cast("long").alias("buckets"),
    )
    rows = sizes.join(named, F.col("source").eqNullSafe(F.col("of")))
    fraction = F.col("rate") - F.floor("rate")
    rows = rows.select(
        "uid",
        "ident",
        "rank",
        F.pmod("ident", "buckets").alias("bucket"),
        "size",
        (F.floor("rate") + (fraction > 1 - EPS).cast("long")).alias("whole"),
        F.when((fraction < EPS) | (fraction > 1 - EPS) | (F.col("size") == 0), F.lit(0.0)).otherwise(fraction).alias("p"),
    ).withColumn("settled", F.col("p") == 0).select(*COLUMNS)
    most = known.agg(F.max("n_docs")).first()[0] or 0
    groups = max(1, -(-most // BUCKET_ROWS))
    rows = stage(rows)
    done, open_rows, level = [rows.where("settled")], rows.where("not settled"), 0
    while True:
        last = groups <= 1
        dealt = open_rows.repartition("rank", "bucket").sortWithinPartitions("rank", "bucket", "ident", "uid")
        out = stage(dealt.mapInArrow(_round_groups(level, seed, last), SCHEMA))
        done.append(out.where("settled"))
        if last:
            break
        open_rows = out.where("not settled").withColumn("bucket", F.floor(F.col("bucket") / F.lit(FAN)).cast("long"))
        groups, level = -(-groups // FAN), level + 1
    settled = done[0]
    for part in done[1:]:
        settled = settled.unionByName(part)
    settled = settled.select("uid", "rank", "size", (F.col("whole") + F.round("p").cast("long")).alias("copies"))
    return settled.join(known.select("rank", "source_size", "target"), "rank")


def document_sizes(df: DataFrame) -> DataFrame:
    """`uid, ident, doc_id, source, size` of every row, stored once; `uid` numbers the rows."""
    size = count_words(text_or_empty(df)).alias("size")
    return stage(
        df.select(df["doc_id"], df["source"], size)
        .withColumn("uid", F.monotonically_increasing_id())
        .withColumn("ident", F.xxhash64("doc_id", "size"))
    )


def decisions(df: DataFrame, seed: int = 7) -> DataFrame:
    """`doc_id, size, source_size, target, copies, taken` of every document."""
    sizes = document_sizes(df)
    out = mix(sizes, seed).join(sizes.select("uid", "doc_id"), "uid")
    return out.select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(df: DataFrame, seed: int = 7) -> DataFrame:
    """The documents of the mix: a row for each copy, with the columns of `df`."""
    uid, copies, no = (free_name(df, c) for c in ("uid", "copies", "no"))
    rows = stage(keep_columns(df, df.columns).withColumn(uid, F.monotonically_increasing_id()))
    size = count_words(text_or_empty(rows)).alias("size")
    sizes = rows.select(F.col(uid).alias("uid"), "doc_id", "source", size)
    sizes = stage(sizes.withColumn("ident", F.xxhash64("doc_id", "size")))
    taken = mix(sizes, seed).where("copies > 0").select(F.col("uid").alias(uid), F.col("copies").cast("int").alias(copies))
    out = rows.join(taken, uid)
    return out.withColumn(no, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*df.columns)

"""Layer tables as Parquet in versioned directories behind one pointer file.

Parquet has no keyed merge, and overwriting what is being read loses rows when the
driver dies half way. So each commit writes new files under a new version and then
publishes a small pointer file that names, per partition value, the directories
that are live. Readers follow the newest pointer and keep a consistent view during
a write; a failed commit leaves only files nobody points to.

An upsert writes what has changed and no more. A side table says on which days a key
has been stored; it lies in buckets by key hash, so that a batch reads the buckets of its
keys, and then only the days they name. Each commit adds a note with its own keys, which the pointer
names as it names data; `compact` folds notes of like size, so that there are few of them and a key is
rewritten a logarithmic number of times. Batch rows that the table already holds are left
out, and a batch without any change publishes no version.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors.exceptions.captured import CapturedException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.operators.incremental import Bounds, bounds_from_max, without_keys
from eventmart.session import stage, staging

_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_WHOLE = "*"
_STAMP = "_commit"
_SIDE = "_side"
COMMIT_TRIES = 5
#: How errors name files that are gone.
_MISSING = ("FILE_NOT_EXIST", "PATH_NOT_FOUND", "FileNotFoundException")
#: Folders of the side table that tells where keys are.
KEY_BUCKETS = 64


def key_bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS)).cast("int")


def _holds_map(dtype: T.DataType) -> bool:
    """Maps cannot be grouped by; their columns are compared as text."""
    if isinstance(dtype, T.StructType):
        return any(_holds_map(f.dataType) for f in dtype.fields)
    return isinstance(dtype, T.MapType) or isinstance(dtype, T.ArrayType) and _holds_map(dtype.elementType)


def foldable(notes: list[dict], least: int) -> list[dict]:
    """The smallest notes up to the last that is at most twice as large as all before it; none if they are fewer than `least`.

    The fold is half as large again as any of its notes, so a row is rewritten a logarithmic number of times; from the
    `least`-th on, each note left is over twice the sum of all smaller ones, so their number is logarithmic too.
    """
    ordered = sorted(notes, key=lambda note: note["rows"])
    n = total = 0
    for i, note in enumerate(ordered):
        if i and note["rows"] <= 2 * total:
            n = i + 1
        total += note["rows"]
    return ordered[:n] if n >= least else []


class ConcurrentCommit(RuntimeError):
    """Another writer published the version this commit was building."""


@dataclass
class Snapshot:
    """One published state: live (partition, write) entries and what they hold."""

    version: int
    schema: str
    entries: list[dict]
    #: Last batch of each writer, and version of each table that the rows were made from.
    batches: dict[str, int]
    #: Whether the side table knows the days of all keys.
    keyed: bool = False
    #: Live parts of the side table: their folder and how many rows they stand for.
    notes: list[dict] = field(default_factory=list)

    def mark(self, column: str):
        """Largest value of a marked column over all live files; None when there is none."""
        found = [e["marks"][column] for e in self.entries if e["marks"].get(column) is not None]
        return max(found, default=None)


class LayerTable:
    """One stored table of a layer.

    `partition_by` is a date column, so that a commit rewrites only the days it
    touches. `sort_by` orders rows inside files, which keeps row-group statistics
    tight for the window filter. `marks` are columns whose maximum each commit
    records, so that the next run gets its bounds without scanning the table.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        name: str,
        partition_by: str | None = None,
        sort_by: str | None = None,
        marks: tuple[str, ...] = (),
    ):
        self.spark = spark
        self.path = f"{root.rstrip('/')}/{name}"
        self.name = name
        self.partition_by = partition_by
        self.sort_by = sort_by
        self.marks = marks

    # ---- pointer files ----

    def _fs(self, path: str):
        jvm = self.spark._jvm
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def versions(self) -> list[int]:
        fs, folder = self._fs(f"{self.path}/_versions")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def snapshot(self, version: int | None = None) -> Snapshot | None:
        """The state of a version, by default the newest; None before the first commit."""
        if version is None:
            known = self.versions()
            if not known:
                return None
            version = known[-1]
        fs, path = self._fs(f"{self.path}/_versions/{version:010d}.json")
        stream = fs.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        body = json.loads(text)
        notes = body.get("notes", [])
        return Snapshot(version, body["schema"], body["entries"], body["batches"], bool(notes) and body.get("keyed", False), notes)

    def _publish(self, snapshot: Snapshot) -> None:
        body = json.dumps(
            {
                "schema": snapshot.schema,
                "entries": snapshot.entries,
                "batches": snapshot.batches,
                "keyed": snapshot.keyed,
                "notes": snapshot.notes,
            }
        )
        # Rival writers have temporary files of their own, and a rename that does not overwrite lets one win.
        final = f"{self.path}/_versions/{snapshot.version:010d}.json"
        fs, temp = self._fs(f"{self.path}/_versions/.{snapshot.version:010d}-{uuid.uuid4().hex}")
        _, target = self._fs(final)
        stream = fs.create(temp, False)
        try:
            stream.write(bytearray(body.encode("utf-8")))
        finally:
            stream.close()
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        hadoop = jvm.org.apache.hadoop.fs
        context = hadoop.FileContext.getFileContext(temp.toUri(), self.spark._jsc.hadoopConfiguration())
        keep = gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
        keep[0] = getattr(getattr(hadoop, "Options$Rename"), "NONE")
        try:
            context.rename(temp, target, keep)
        except Py4JJavaError as error:
            fs.delete(temp, False)
            if "FileAlreadyExists" not in str(error.java_exception):
                raise
            raise ConcurrentCommit(final) from None

    # ---- reading ----

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self, version: int | None = None) -> DataFrame | None:
        """The table as of a version, or None when it was never written."""
        snapshot = self.snapshot(version)
        if snapshot is None:
            return None
        return self._read_entries(snapshot.entries, T.StructType.fromJson(json.loads(snapshot.schema)))

    def _read_entries(self, entries: list[dict], schema: T.StructType) -> DataFrame:
        if not entries:
            return self.spark.createDataFrame([], schema)
        if self.partition_by is None:
            paths = [f"{self.path}/data/{_STAMP}={e['write']}" for e in entries]
        else:
            paths = [
                f"{self.path}/data/{_STAMP}={e['write']}/{self.partition_by}={e['part']}" for e in entries
            ]
        with_stamp = T.StructType([*schema.fields, T.StructField(_STAMP, T.StringType())])
        return (
            self.spark.read.schema(with_stamp)
            .option("basePath", f"{self.path}/data")
            .parquet(*paths)
            .select(*schema.names)
        )

    def bounds(self, window_col: str, minutes: int) -> Bounds | None:
        """Lookback bounds from the recorded marks; None when the table cannot give them."""
        snapshot = self.snapshot()
        if snapshot is None or window_col not in self.marks:
            return None
        newest = snapshot.mark(window_col)
        return bounds_from_max(datetime.fromisoformat(newest) if newest else None, minutes)

    # ---- writing ----

    def _write(self, df: DataFrame, version: int) -> list[dict]:
        """Write rows to a directory of their own; one entry per partition value written.

        The directory name is unique, so files of a failed or a rival attempt are
        never mixed with those of this one.
        """
        write = f"{version:010d}-{uuid.uuid4().hex}"
        path = f"{self.path}/data/{_STAMP}={write}"
        # The rebalance hint lets AQE split a day that holds most rows and merge small ones.
        adaptive = df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
        if adaptive:
            df = df.hint("rebalance", *([self.partition_by] if self.partition_by else []))
        if self.partition_by:
            order = [self.partition_by] + ([self.sort_by] if self.sort_by else [])
            df.sortWithinPartitions(*order).write.partitionBy(self.partition_by).parquet(path)
        else:
            df.write.parquet(path)
        written = self.spark.read.schema(df.schema).parquet(path)
        part = F.col(self.partition_by).cast("string") if self.partition_by else F.lit(_WHOLE)
        rows = (
            written.groupBy(part.alias("_part"))
            .agg(
                F.count(F.lit(1)).alias("_rows"),
                *[F.max(c).cast("string").alias(c) for c in self.marks],
            )
            .collect()
        )
        return [
            {
                "part": r["_part"] if r["_part"] is not None else _NULL_PARTITION,
                "write": write,
                "rows": r["_rows"],
                "marks": {c: r[c] for c in self.marks},
            }
            for r in rows
        ]

    def replace(self, df: DataFrame, made_from: dict[str, int] | None = None) -> int:
        """Full refresh: the table becomes `df`. `made_from` notes the versions of the tables it comes from."""
        return self._retried(lambda: self._replace(df, None, made_from))

    def replace_days(self, df: DataFrame, days: list[str], made_from: dict[str, int] | None = None) -> int:
        """The table's rows of these days become `df`, the others stay."""
        return self._retried(lambda: self._replace(df, set(days), made_from))

    def changed_days(self, since: int) -> list[str] | None:
        """Days whose files differ between a version and the newest; None where the older one has expired."""
        known = self.versions()
        if since not in known:
            return None
        files = []
        for version in (since, known[-1]):
            days: dict[str, set] = {}
            for e in self.snapshot(version).entries:
                days.setdefault(e["part"], set()).add(e["write"])
            files.append(days)
        return sorted(d for d in {**files[0], **files[1]} if files[0].get(d) != files[1].get(d))

    def difference(self, since: int | None, columns: list[str]) -> tuple[DataFrame | None, DataFrame | None]:
        """`columns` of the files that came and of those that went between a version and the newest; None for no files.

        Rows that a commit carried over into a new file are in both. `since=None` takes the whole table as new; any
        other version must still be there.
        """
        now = self.snapshot()
        before = self.snapshot(since).entries if since is not None else []

        def name(e):
            return e["part"], e["write"]

        held, live = {name(e) for e in before}, {name(e) for e in now.entries}
        schema = T.StructType.fromJson(json.loads(now.schema))
        come = [e for e in now.entries if name(e) not in held]
        gone = [e for e in before if name(e) not in live]
        return tuple(self._read_entries(entries, schema).select(*columns) if entries else None for entries in (come, gone))

    def rows_of(self, keys: DataFrame, key: str) -> DataFrame:
        """The live rows with a key of `keys`; only days that may hold one are read."""
        snapshot = self.snapshot()
        schema = T.StructType.fromJson(json.loads(snapshot.schema))
        return self._read_entries(self._days_of(snapshot, keys, key), schema).join(keys.select(key).distinct(), key, "left_semi")

    def read_days(self, days: list[str]) -> DataFrame:
        """The rows of some days, from their files alone."""
        snapshot = self.snapshot()
        entries = [e for e in snapshot.entries if e["part"] in set(days)]
        return self._read_entries(entries, T.StructType.fromJson(json.loads(snapshot.schema)))

    def _retried(self, commit):
        """Run a commit again, from the then newest version, when a rival published first.

        A commit that has lost may also learn so from files that the rival's `expire` has deleted under it.
        """
        for left in reversed(range(COMMIT_TRIES)):
            known = self.versions()
            try:
                return commit()
            except ConcurrentCommit:
                if not left:
                    raise
            except (Py4JJavaError, CapturedException) as error:
                beaten = self.versions()[-1:] != known[-1:]
                if not left or not beaten or not any(sign in str(error) for sign in _MISSING):
                    raise

    def _replace(self, df: DataFrame, days: set[str] | None, made_from: dict[str, int] | None) -> int:
        snapshot = self.snapshot()
        version = snapshot.version + 1 if snapshot else 1
        entries = self._write(df, version)
        if days is not None and snapshot:
            entries = [e for e in snapshot.entries if e["part"] not in days] + entries
        batches = {**(snapshot.batches if snapshot else {}), **(made_from or {})}
        self._publish(Snapshot(version, df.schema.json(), entries, batches))
        return version

    def upsert(
        self,
        batch: DataFrame | Callable[[DataFrame | None], DataFrame],
        key: str,
        writer: str | None = None,
        batch_id: int | None = None,
        retract: Callable[[DataFrame], DataFrame] | None = None,
        ignore: tuple[str, ...] = (),
    ) -> int | None:
        """Keyed upsert: stored rows with a key of the batch go, the batch rows come.

        `batch` may be a function of the table as it is (None before the first commit). It is
        evaluated against the version that the commit replaces, again if a rival was first, so that a
        condition on stored rows holds when it is published.

        Only keys whose rows differ from the stored ones are written, as multisets and with NULL equal to
        NULL; columns in `ignore` do not count. Rows with a NULL key are always added. Days
        without a changed key are not rewritten, they only gain files. `retract` derives further keys to remove from the rows
        just written. A `writer` that repeats a `batch_id` it has already committed changes nothing and gets None.
        """
        return self._retried(lambda: self._upsert(batch, key, writer, batch_id, retract, ignore))

    def _upsert(self, batch, key, writer, batch_id, retract, ignore) -> int | None:
        snapshot = self.snapshot()
        if snapshot and writer is not None and snapshot.batches.get(writer, -1) >= batch_id:
            return None
        version = snapshot.version + 1 if snapshot else 1
        stored_schema = T.StructType.fromJson(json.loads(snapshot.schema)) if snapshot else None
        if callable(batch):
            batch = batch(self._read_entries(snapshot.entries, stored_schema) if snapshot else None)
        schema, entries = batch.schema, snapshot.entries if snapshot else []
        if not entries:
            added = self._write(batch, version)
            if snapshot and not added and writer is None:
                return snapshot.version
            notes = self._note_keys(added, batch.schema, key)
            return self._commit(snapshot, version, schema, added, writer, batch_id, notes)
        known = set(stored_schema.names)
        schema = T.StructType([*stored_schema.fields, *[f for f in batch.schema.fields if f.name not in known]])
        with staging(self.spark):
            rows = stage(batch)
            rows = self._changed(snapshot, schema, rows, key, ignore)
            added = self._write(rows, version)
            if not added and writer is None:
                return snapshot.version
            if added:
                written = self._read_entries(added, rows.schema)
                keys = written.select(key) if retract is None else written.select(key).unionByName(retract(written).select(key))
                entries = self._without(snapshot, schema, keys, key, version)
            notes = snapshot.notes + self._note_keys(added, rows.schema, key) if snapshot.keyed else []
        return self._commit(snapshot, version, schema, entries + added, writer, batch_id, notes)

    def _commit(self, snapshot, version, schema, entries, writer, batch_id, notes) -> int:
        batches = dict(snapshot.batches) if snapshot else {}
        if writer is not None:
            batches[writer] = batch_id
        self._publish(Snapshot(version, schema.json(), entries, batches, bool(notes), notes))
        return version

    # ---- where keys are ----

    @property
    def _keys_path(self) -> str:
        return f"{self.path}/keys"

    def _note_keys(self, added: list[dict], schema: T.StructType, key: str) -> list[dict]:
        """The note that tells the days of the keys of rows just written; none without days or rows.

        A key that goes later names a day in vain and costs a look; none is ever missing.
        """
        if self.partition_by is None or not added:
            return []
        day = F.col(self.partition_by).cast("string")
        rows = self._read_entries(added, schema).where(F.col(key).isNotNull())
        rows = rows.select(F.col(key).cast("string").alias("key"), F.coalesce(day, F.lit(_NULL_PARTITION)).alias("day"))
        return [self._write_note(rows, added[0]["write"], sum(e["rows"] for e in added))]

    def _write_note(self, rows: DataFrame, write: str, size: int) -> dict:
        """One exchange, of which adaptive execution merges small buckets and splits large ones."""
        rows = rows.withColumn("bucket", key_bucket(F.col("key")))
        adaptive = self.spark.conf.get("spark.sql.adaptive.enabled") == "true"
        rows = rows.hint("rebalance", "bucket") if adaptive else rows.repartition("bucket")
        rows.sortWithinPartitions("bucket", "key").write.partitionBy("bucket").parquet(f"{self._keys_path}/{_STAMP}={write}")
        return {"write": write, "rows": size}

    def _read_notes(self, notes: list[dict]) -> DataFrame:
        paths = [f"{self._keys_path}/{_STAMP}={n['write']}" for n in notes]
        notes = self.spark.read.schema(f"key string, day string, {_STAMP} string, bucket int")
        return notes.option("basePath", self._keys_path).parquet(*paths).select("key", "day", "bucket")

    def key_days(self, keys: DataFrame, key: str, snapshot: Snapshot | None = None) -> DataFrame:
        """`key, day`: the days on which a key of `keys` has been stored. Only the buckets of the keys are read."""
        snapshot = snapshot or self.snapshot()
        own = keys.select(F.col(key).cast("string").alias("key")).where("key is not null").distinct()
        own = own.withColumn("bucket", key_bucket(F.col("key")))
        buckets = [r["bucket"] for r in own.select("bucket").distinct().collect()]  # KEY_BUCKETS at most
        noted = self._read_notes(snapshot.notes).where(F.col("bucket").isin(buckets))
        return noted.join(own, ["bucket", "key"]).select("key", "day")

    def _days_of(self, snapshot: Snapshot, keys: DataFrame, key: str) -> list[dict]:
        """The live entries on days that may hold one of the keys."""
        if not snapshot.keyed:
            return snapshot.entries
        days = {r["day"] for r in self.key_days(keys, key, snapshot).select("day").distinct().collect()}  # a row per day
        return [e for e in snapshot.entries if e["part"] in days]

    # ---- what changes ----

    def _changed(self, snapshot, schema, batch: DataFrame, key: str, ignore: tuple[str, ...]) -> DataFrame:
        """The batch's rows of keys that the table holds otherwise or not at all."""
        near = self._days_of(snapshot, batch, key)
        if not near:
            return batch
        names = [f.name for f in schema.fields if f.name not in ignore]

        def whole(df: DataFrame) -> DataFrame:
            """All columns of the schema, in a form that can be grouped by."""
            out = []
            for f in schema.fields:
                if f.name in names:
                    own = F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
                    out.append((F.to_json(F.struct(own)) if _holds_map(f.dataType) else own).alias(f.name))
            return df.select(*out)

        stored = whole(self._read_entries(near, schema)).join(batch.select(key).distinct(), key, "left_semi").select(*names)
        both = whole(batch).withColumn(_SIDE, F.lit(1)).unionByName(stored.withColumn(_SIDE, F.lit(-1)))
        # Grouping takes NULL for equal to NULL, in nested columns too.
        other = both.groupBy(*names).agg(F.sum(_SIDE).alias(_SIDE)).where(f"{_SIDE} <> 0").select(key).distinct()
        changed = batch.where(F.col(key).isNotNull()).join(other, key, "left_semi").select(*batch.columns)
        return stage(changed.unionByName(batch.where(F.col(key).isNull())))

    def _without(self, snapshot, schema, keys: DataFrame, key: str, version: int) -> list[dict]:
        """Live entries after the rows with `keys` are gone; only days with hits are rewritten."""
        near = self._days_of(snapshot, keys, key)
        if not near:
            return snapshot.entries
        stored = self._read_entries(near, schema)
        part = F.col(self.partition_by).cast("string") if self.partition_by else F.lit(_WHOLE)
        hits = {
            r["_part"] if r["_part"] is not None else _NULL_PARTITION
            for r in stored.select(key, part.alias("_part"))
            .join(keys.distinct(), key, "left_semi")
            .select("_part")
            .distinct()
            .collect()
        }
        if not hits:
            return snapshot.entries
        touched = [e for e in snapshot.entries if e["part"] in hits]
        untouched = [e for e in snapshot.entries if e["part"] not in hits]
        survivors = without_keys(self._read_entries(touched, schema), keys, key)
        return untouched + self._write(survivors, version)

    def compact(self, min_files: int = 8) -> int | None:
        """Rewrite the days that have gathered files of many commits into one each, and fold as many notes of keys into one."""
        return self._retried(lambda: self._compact(min_files))

    def _compact(self, min_files: int) -> int | None:
        snapshot = self.snapshot()
        if snapshot is None:
            return None
        count: dict[str, int] = {}
        for e in snapshot.entries:
            count[e["part"]] = count.get(e["part"], 0) + 1
        many = [e for e in snapshot.entries if count[e["part"]] >= min_files]
        folded = foldable(snapshot.notes, min_files)
        if not many and not folded:
            return None
        version = snapshot.version + 1
        entries, notes = snapshot.entries, snapshot.notes
        if many:
            schema = T.StructType.fromJson(json.loads(snapshot.schema))
            rewritten = self._write(self._read_entries(many, schema), version)
            entries = [e for e in snapshot.entries if count[e["part"]] < min_files] + rewritten
        if folded:
            # The same keys lie on the same days in the rewritten files.
            write = f"{version:010d}-{uuid.uuid4().hex}"
            rows = self._read_notes(folded).select("key", "day").distinct()
            notes = [n for n in notes if n not in folded] + [self._write_note(rows, write, sum(n["rows"] for n in folded))]
        self._publish(Snapshot(version, snapshot.schema, entries, snapshot.batches, snapshot.keyed, notes))
        return version

    def expire(self, keep: int = 3) -> list[str]:
        """Delete pointers but the newest `keep`, and data no kept pointer names."""
        known = self.versions()
        gone, kept = known[:-keep], known[-keep:]
        states = [self.snapshot(v) for v in kept]
        for v in gone:
            fs, path = self._fs(f"{self.path}/_versions/{v:010d}.json")
            fs.delete(path, False)
        newest = kept[-1] if kept else 0
        removed = self._sweep(f"{self.path}/data", {e["write"] for s in states for e in s.entries}, newest)
        self._sweep(self._keys_path, {n["write"] for s in states for n in s.notes}, newest)
        return removed

    def _sweep(self, folder: str, live: set[str], newest: int) -> list[str]:
        """Delete the writes in a folder that are not live; those of versions after the newest may belong to a commit under way."""
        fs, path = self._fs(folder)
        removed = []
        for status in fs.listStatus(path) if fs.exists(path) else []:
            write = status.getPath().getName().split("=")[1]
            if write not in live and int(write.split("-")[0]) <= newest:
                fs.delete(status.getPath(), True)
                removed.append(write)
        return sorted(removed)

"""Check reports that look at what changed, not at the whole table.

Files are never altered, so the rows that fail a check are those of the last report, plus the
failing rows of files that came since, less those of files that went. Uniqueness of the table's key
is kept as a table of repeated keys, which is small where data are sound: keys whose count the new
files change are counted again on the days that the key side table names, all others stand.

The first report, and one whose older version has expired, counts everything. A `unique` check on
other columns than the key is run on the whole table each time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.operators.quality import Check, row_faults, run_checks
from eventmart.plans.store import LayerTable
from eventmart.session import stage, staging

_REPORT = "check string, column string, failing_rows long, passed boolean"


class CheckState:
    """What the last report of a suite on `table` found, stored under `root`.

    Repeated keys are the rows of one table; the failing rows of each check and the version that was judged are
    noted with them, in one commit.
    """

    def __init__(self, table: LayerTable, key: str, checks: list[Check], root: str):
        self.table = table
        self.key = key
        self.checks = checks
        self.row_wise = [c for c in checks if c.kind != "unique"]
        self.repeats = LayerTable(table.spark, root, f"{table.name}_repeats")

    def report(self) -> DataFrame:
        """(check, column, failing_rows, passed), the rows of `run_checks` on the whole table."""
        spark = self.table.spark
        with staging(spark):
            self._follow()
        state = self.repeats.snapshot()
        found = []
        for c in [*self.row_wise, *[c for c in self.checks if c.kind == "unique"]]:
            if c.kind != "unique":
                n = state.batches[repr(c)]
            elif c.column == self.key:
                n = sum(e["rows"] for e in state.entries)
            else:
                n = run_checks(self.table.read(), [c]).first()["failing_rows"]
            found.append((c.kind, c.column_label, n, n == 0))
        return spark.createDataFrame(found, _REPORT)

    def _follow(self) -> None:
        """Bring the state to the newest version of the table."""
        newest = self.table.versions()[-1]
        held = self.repeats.snapshot()
        notes = held.batches if held else {}
        labels = [repr(c) for c in self.row_wise]
        seen = notes.get(self.table.name)
        if seen not in self.table.versions() or any(label not in notes for label in labels):
            seen = None
        if seen == newest:
            return
        key = self.key
        columns = list(dict.fromkeys([key, *(c.column for c in self.row_wise)]))
        # Files that stay as they are, read by column: storing them again would cost more than the second look.
        come, gone = self.table.difference(seen, columns)
        faults = {label: notes[label] if seen is not None else 0 for label in labels}
        for sign, files in ((1, come), (-1, gone)):
            if files is not None and labels:
                row = files.agg(*row_faults(self.row_wise)).first()
                faults = {label: faults[label] + sign * row[i] for i, label in enumerate(labels)}
        notes = {self.table.name: newest, **faults}
        if seen is None:
            found = _repeated(come, key) if come is not None else self.table.read().select(key).withColumn("n", F.lit(0).cast("long"))
            self.repeats.replace(found, notes)
            return
        sides = [df.select(key).withColumn("_n", F.lit(sign)) for df, sign in ((come, 1), (gone, -1)) if df is not None]
        if not sides:
            self.repeats.replace(self.repeats.read(), notes)
            return
        both = reduce(DataFrame.unionByName, sides)
        altered = both.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum("_n").alias("_n")).where("_n <> 0")
        altered = stage(altered.select(key))
        now = _repeated(self.table.rows_of(altered, key).select(key), key)
        kept = self.repeats.read().join(altered, key, "left_anti")
        self.repeats.replace(stage(kept.unionByName(now)), notes)


def _repeated(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")

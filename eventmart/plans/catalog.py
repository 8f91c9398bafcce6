"""Layer tables in the session catalog, so that other sessions can query them by name.

Each published version gets an external table over the files that it names: the folders of a
layer table are `_commit=.../day=...`, so the live ones are just its partitions. A view
`layer.table` is then pointed at the new version in one statement: a query that runs keeps the version it
saw, the next one sees the newest. Data are never touched; only names beyond the newest `keep` go.

A partition is listed for each live folder, so a filter on the day reads no other day's files. With a
metastore the names outlive the application; without one they are shared by its sessions.
"""

from __future__ import annotations

import json
import zlib

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from eventmart.plans.store import _NULL_PARTITION, _STAMP, _WHOLE, LayerTable

#: Partitions named in one statement.
_AT_ONCE = 200


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _stem(table: LayerTable) -> str:
    """What the names of a table's versions begin with; a table of that name under another root has its own."""
    return f"{table.name}_{zlib.crc32(table.path.encode()):08x}_v"


def publish(spark: SparkSession, table: LayerTable, namespace: str, keep: int = 2) -> str | None:
    """Point `namespace.table` at the newest version; its name, or None before the first commit.

    Publishing the version that is there already changes nothing.
    """
    snapshot = table.snapshot()
    if snapshot is None:
        return None
    view = f"{_quoted(namespace)}.{_quoted(table.name)}"
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {_quoted(namespace)}")
    own = f"{_stem(table)}{snapshot.version:010d}"
    at = f"{_quoted(namespace)}.{_quoted(own)}"
    if not spark.catalog.tableExists(f"{namespace}.{own}"):
        _create(spark, table, snapshot, at)
    columns = ", ".join(_quoted(c) for c in T.StructType.fromJson(json.loads(snapshot.schema)).names)
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {columns} FROM {at}")
    _drop_older(spark, table, namespace, keep)
    return f"{namespace}.{table.name}"


def _create(spark: SparkSession, table: LayerTable, snapshot, at: str) -> None:
    schema = T.StructType.fromJson(json.loads(snapshot.schema))
    day = table.partition_by
    parts = [_STAMP, *([day] if day else [])]
    kept = [f for f in schema.fields if f.name != day]
    typed = [f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in kept]
    typed.append(f"{_quoted(_STAMP)} string")
    if day:
        typed.append(f"{_quoted(day)} {schema[day].dataType.simpleString()}")
    # A run that died between the table and its partitions leaves a name with a part of them: it is made anew.
    building = at[:-1] + "_building`"
    spark.sql(f"DROP TABLE IF EXISTS {building}")
    by = ", ".join(_quoted(p) for p in parts)
    spark.sql(
        f"CREATE TABLE {building} ({', '.join(typed)}) USING parquet PARTITIONED BY ({by}) LOCATION {_text(table.path + '/data')}"
    )
    specs = []
    for part, write in sorted({(e["part"], e["write"]) for e in snapshot.entries}):
        spec = f"{_quoted(_STAMP)} = {_text(write)}"
        if part != _WHOLE:
            spec += f", {_quoted(day)} = " + ("NULL" if part == _NULL_PARTITION else _text(part))
        specs.append(f"PARTITION ({spec})")
    for i in range(0, len(specs), _AT_ONCE):
        spark.sql(f"ALTER TABLE {building} ADD IF NOT EXISTS {' '.join(specs[i:i + _AT_ONCE])}")
    spark.sql(f"ALTER TABLE {building} RENAME TO {at}")


def _drop_older(spark: SparkSession, table: LayerTable, namespace: str, keep: int) -> None:
    stem = _stem(table)
    names = [t.name for t in spark.catalog.listTables(namespace, f"{stem}*")]
    versions = sorted(n for n in names if n[len(stem):].isdigit())
    for name in versions[:-keep]:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(namespace)}.{_quoted(name)}")

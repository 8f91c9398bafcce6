from pyspark.sql import functions as F

from eventmart.plans import catalog
from eventmart.plans.store import LayerTable


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, day string, v int").select("id", F.col("day").cast("date").alias("day"), "v")


def seen(session, name):
    return sorted((r["id"], str(r["day"]), r["v"]) for r in session.sql(f"SELECT * FROM {name}").collect())


def test_another_session_sees_the_newest_version(spark, tmp_path):
    table = LayerTable(spark, str(tmp_path), "things", "day", "id")
    assert catalog.publish(spark, table, "cat_test") is None
    table.upsert(frame(spark, ("a", "2024-01-01", 1), ("b", "2024-01-02", 1), ("c", None, 1)), "id")
    name = catalog.publish(spark, table, "cat_test")
    other = spark.newSession()
    assert name == "cat_test.things"
    assert seen(other, name) == [("a", "2024-01-01", 1), ("b", "2024-01-02", 1), ("c", "None", 1)]
    running = other.table(name)
    table.upsert(frame(spark, ("a", "2024-01-03", 2), ("c", None, 2)), "id")
    catalog.publish(spark, table, "cat_test")
    catalog.publish(spark, table, "cat_test")
    assert seen(other, name) == [("a", "2024-01-03", 2), ("b", "2024-01-02", 1), ("c", "None", 2)]
    assert sorted(r["v"] for r in running.collect()) == [1, 1, 1]
    table.upsert(frame(spark, ("d", "2024-01-03", 3)), "id")
    catalog.publish(spark, table, "cat_test", keep=1)
    held = [t.name for t in other.catalog.listTables("cat_test")]
    assert len(held) == 2 and "things" in held and any(n.endswith("_v0000000003") for n in held)
    elsewhere = LayerTable(spark, str(tmp_path / "elsewhere"), "things", "day", "id")
    for v in (7, 8, 9):
        elsewhere.upsert(frame(spark, ("z", "2024-01-01", v)), "id")
    catalog.publish(spark, elsewhere, "cat_test")
    assert seen(other, name) == [("z", "2024-01-01", 9)]
    catalog.publish(spark, table, "cat_test")
    assert seen(other, name) == sorted((r["id"], str(r["day"]), r["v"]) for r in table.read().collect())
    day = other.sql(f"SELECT id FROM {name} WHERE day = DATE '2024-01-03'")
    assert len(day.inputFiles()) >= 2 and sorted(r["id"] for r in day.collect()) == ["a", "d"]
    plan = day._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_tables_without_days_and_without_rows(spark, tmp_path):
    mart = LayerTable(spark, str(tmp_path), "mart")
    mart.replace(frame(spark, ("a", "2024-01-01", 1)))
    name = catalog.publish(spark, mart, "cat_test")
    query = "cat_test.`mart`"
    assert name == "cat_test.mart" and seen(spark, query) == [("a", "2024-01-01", 1)]
    mart.replace(frame(spark, ("x", "2024-01-01", 1)).limit(0))
    catalog.publish(spark, mart, "cat_test")
    assert seen(spark, query) == []

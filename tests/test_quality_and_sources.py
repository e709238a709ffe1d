"""Gates that must be able to fire, layouts, snapshots and materialisation."""

import pytest
from helpers import rows, same
from pyspark.sql import functions as F

from millrace import session
from millrace.functions.values import exact_total
from millrace.operators import quality
from millrace.operators.quality import GateError, Gates
from millrace.plans import reports
from millrace.sources import layout, snapshots, tables

DDL = "id int, grp string, v double"


def good(spark):
    return spark.createDataFrame([(1, "a", 1.5), (2, None, 2.5)], DDL)


@pytest.mark.parametrize(
    "name,data,ddl,gates",
    [
        ("unique", [(1, None, 1.0), (1, None, 2.0)], DDL, Gates(unique=["id", "grp"])),
        ("not null", [(None, "a", 1.0)], DDL, Gates(not_null=["grp", "id"])),
        ("negative", [(1, "a", -1.0)], DDL, "negative"),
        ("total", [(1, "a", 1.0)], DDL, "total"),
        ("schema", [(1, "a", 1.0)], "id bigint, grp string, v double", Gates(ddl=DDL)),
        ("schema", [("a", 1, 1.0)], "grp string, id int, v double", Gates(ddl=DDL)),
    ],
)
def test_each_gate_fires(spark, name, data, ddl, gates):
    if gates == "negative":
        gates = Gates(violations={"negative": F.col("v") < 0})
    if gates == "total":
        gates = Gates(totals={"total": (exact_total("v"), 2)})
    with pytest.raises(GateError, match=name):
        quality.publish(spark.createDataFrame(data, ddl), gates)


def test_gates_pass_on_valid_and_on_empty_input(spark):
    gates = Gates(
        unique=["id"],
        not_null=["id", "v"],
        violations={"negative": F.col("v") < 0},
        totals={"rows": (F.count(F.lit(1)), 2), "sum": (exact_total("v"), 4)},
        ddl=DDL,
    )
    same(quality.publish(good(spark), gates), rows(good(spark)), DDL)
    empty = Gates(gates.unique, gates.not_null, gates.violations, {"rows": (F.count(F.lit(1)), 0), "sum": (exact_total("v"), 0)}, DDL)
    assert quality.publish(good(spark).limit(0), empty).count() == 0
    with pytest.raises(GateError, match="rows"):
        quality.check(good(spark).limit(0), gates)


def test_published_rows_are_the_checked_rows(spark):
    moving = spark.range(20).select(F.rand().alias("r"), F.col("id").cast("int").alias("id"))
    done = quality.publish(moving, Gates(unique=["id"]))
    assert rows(done) == rows(done)


def test_same_rows(spark):
    assert quality.same_rows(good(spark), good(spark))
    assert not quality.same_rows(good(spark), good(spark).union(good(spark).limit(1)))


@pytest.mark.parametrize("how", ["table", "checkpoint", "persist"])
def test_materialise(spark, how):
    df = good(spark).withColumn("arr", F.array("id"))
    got = session.materialise(df, how)
    assert got.dtypes == df.dtypes and rows(got.drop("arr")) == rows(good(spark))
    if how == "persist":
        got.unpersist()


def test_shared_dir_wants_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Spark:
        conf = Conf()
        sparkContext = type("C", (), {"master": "yarn"})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Spark(), "x")


def test_partitioned_write_is_one_file_per_folder_and_safe_to_rerun(spark):
    data = [(f"d{i}", ["t", "p"][i % 2], f"2025-05-0{1 + i % 3} 10:00:00", float(i)) for i in range(30)]
    data += [("d1", "t", "2025-05-01 11:00:00", 150.0), ("d1", "t", "2025-05-01 11:00:00", -10.0), ("d1", "t", "2025-05-01 11:00:00", None)]
    readings = spark.createDataFrame(data, "device_id string, sensor_type string, timestamp string, reading double")
    readings = readings.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).repartition(5)
    path = session.shared_dir(spark, "t")
    reports.publish_sensor_daily(readings, path)
    reports.publish_sensor_daily(readings.filter("sensor_type = 't'"), path)
    census = layout.partition_census(spark, path, ["sensor_type", "date"])
    assert census.count() == 6 and rows(census.select("n_files").distinct()) == [(1,)]
    assert census.agg(F.sum("n_rows")).first()[0] == 30


def test_partitioned_write_can_spread_one_folder(spark):
    df = spark.range(4000).select("id", F.lit("one").alias("k"))
    path = session.shared_dir(spark, "t")
    layout.write_partitioned(df, path, ["k"], spread="id", files_per_folder=3)
    got = layout.partition_census(spark, path, ["k"]).first()
    assert 1 <= got["n_files"] <= 3 and got["n_rows"] == 4000
    with pytest.raises(ValueError):
        layout.write_partitioned(df, path, ["k"], files_per_folder=3)


def test_snapshot_audit(spark):
    ddl = "product_id string, price double, category string"
    old = spark.createDataFrame([("m", 10.0, "x"), ("c", 5.0, "y"), ("n", None, "z"), ("gone", 1.0, "z")], ddl)
    new = spark.createDataFrame([("m", 510.5, "x"), ("c", 5.0, "y"), ("n", 3.0, "z"), ("new", 1.0, "z")], ddl)
    root = session.shared_dir(spark, "t")
    snapshots.write_version(old, root, 3)
    snapshots.write_version(new, root, 4)
    got = reports.price_audit(snapshots.read_version(spark, root, 4, ddl), snapshots.read_version(spark, root, 3, ddl))
    want = [("m", 510.5, 10.0, 500.5), ("n", 3.0, None, None)]
    same(got, want, "product_id string, current_price double, original_price double, price_diff double")


def test_relations_for_sql(spark):
    tables.register(known=good(spark))
    assert spark.sql("SELECT count(*) FROM known").first()[0] == 2
    assert tables.sql(spark, "SELECT sum(v) AS s FROM {x}", x=good(spark)).first()["s"] == 4.0
    hot = tables.cache_view(spark, "warm", good(spark))
    assert spark.catalog.isCached("warm") and hot.count() == 2
    spark.catalog.uncacheTable("warm")


def test_declared_schema_reaches_the_scan(spark):
    df = tables.given(spark, "/root/testdata/sf0.001", "events")
    plan = df.filter("user_id = 3").select("value")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(user_id), EqualTo(user_id,3)]" in plan
    assert "ReadSchema: struct<user_id:bigint,value:double>" in plan

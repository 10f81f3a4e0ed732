"""Datasets come back as they were written; a failed or late write leaves what was there."""

import datetime
import decimal

import pytest
from pyspark.sql import functions as F

from vantage.sources import versions as vs
from vantage.sources.datasets import DatasetStore, read_dataset, write_dataset

KEYS = ["01", "1", "", None, "a/b=c", "__HIVE_DEFAULT_PARTITION__", " x ", "é", "null", "1e2"]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("versioned", [True, False])
def test_partition_values_come_back(spark, tmp_path, versioned):
    df = spark.createDataFrame([(i, k, "v" if i % 2 else None) for i, k in enumerate(KEYS)], "n int, k string, by0 string")
    path = str(tmp_path / "d")
    (vs.write_version if versioned else vs.replace_folder)(df, path, partition_by=["k"])
    back = read_dataset(spark, path)
    assert back.columns == df.columns and back.dtypes == df.dtypes
    assert rows_of(back) == rows_of(df)
    for k in ("01", "", "a/b=c"):
        assert rows_of(back.where(F.col("k") == k)) == rows_of(df.where(F.col("k") == k))
    assert back.where("k IS NULL").count() == 1


def test_partition_types(spark, tmp_path):
    """Every flat type as the only columns of a dataset, under another time zone when read."""
    kinds = ("b boolean, i int, l bigint, f float, d double, dec decimal(20,4), day date, ts timestamp, tn timestamp_ntz, "
             "bin binary, s string")
    now = datetime.datetime(2024, 10, 27, 0, 30, 1, 123456)
    full = (True, -5, 1 << 60, 0.1, -1e-300, decimal.Decimal("12345678901.5000"), datetime.date(1, 1, 1), now, now, bytearray(b"\x00/"), "x")
    df = spark.createDataFrame([full, tuple([None] * 11), (False, 0, 0, float("inf"), float("-inf"), decimal.Decimal(0),
                                                           datetime.date(2024, 2, 29), now, now, bytearray(), "")], kinds)
    path = str(tmp_path / "d")
    write_dataset(df, path, partition_by=df.columns)
    want = rows_of(df.withColumn("ts", F.unix_micros("ts")))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        back = read_dataset(spark, path)
        assert back.dtypes == df.dtypes
        assert rows_of(back.withColumn("ts", F.unix_micros("ts"))) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_filters_prune_folders_and_reach_the_files(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "CAST(id % 4 AS STRING) AS k", "id % 7 AS m")
    path = str(tmp_path / "d")
    write_dataset(df, path, partition_by=["k", "m"], sort_within=["id"])
    plan = read_dataset(spark, path).where("k = '3' AND m > 5 AND id < 10").select("id")._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "by0" in filters and "by1" in filters
    assert "LessThan(id,10)" in plan.replace(" ", "")


def test_failed_write_leaves_the_dataset(spark, tmp_path):
    good = spark.range(5).toDF("id")
    bad = spark.range(100).selectExpr("id", "CASE WHEN id = 50 THEN raise_error('stop') ELSE 'x' END AS v")
    for write, name in ((vs.write_version, "a"), (vs.replace_folder, "b")):
        path = str(tmp_path / name)
        write(good, path)
        before = sorted(str(p) for p in tmp_path.rglob("*"))
        with pytest.raises(Exception, match="stop"):
            write(bad, path)
        assert rows_of(read_dataset(spark, path)) == [(i,) for i in range(5)]
        assert sorted(str(p) for p in tmp_path.rglob("*")) == before


def test_versions(spark, tmp_path):
    store = DatasetStore(spark, str(tmp_path))
    for n in range(1, 5):
        store.write("x", spark.range(n).toDF(f"c{n}"))
    assert store.versions("x") == [3, 4]
    assert store.read("x").columns == ["c4"] and store.read("x").count() == 4
    assert store.read("x", 3).columns == ["c3"] and store.read("x", 3).count() == 3
    with pytest.raises(FileNotFoundError):
        store.read("x", 1)
    assert len(list((tmp_path / "x").glob("data-*"))) == 2


def test_second_writer_is_told(spark, tmp_path):
    path = str(tmp_path / "x")
    vs.write_version(spark.range(1), path)
    folder = vs._Folder(spark, path)
    folder.add(f"{vs.MANIFESTS}/0000000002.json", "{}")
    with pytest.raises(vs.VersionConflict):
        folder.add(f"{vs.MANIFESTS}/0000000002.json", "{}")
    assert folder.read(f"{vs.MANIFESTS}/0000000002.json") == "{}"


def test_a_query_reads_the_dataset_it_replaces(spark, tmp_path):
    """The old files stay until the new ones are complete, so a dataset can be rewritten from itself."""
    path = str(tmp_path / "x")
    write_dataset(spark.range(10).selectExpr("id", "CAST(NULL AS STRING) AS k"), path, partition_by=["k"])
    write_dataset(read_dataset(spark, path).withColumn("k", F.lit("")), path, partition_by=["k"])
    assert rows_of(read_dataset(spark, path)) == [(i, "") for i in range(10)]


def test_versions_replace_a_plain_folder(spark, tmp_path):
    path = str(tmp_path / "x")
    spark.range(3).write.parquet(path)
    assert read_dataset(spark, path).count() == 3
    vs.write_version(spark.range(0).selectExpr("id", "'p' AS k"), path, partition_by=["k"])
    back = read_dataset(spark, path)
    assert back.columns == ["id", "k"] and back.count() == 0
    assert not list((tmp_path / "x").glob("part-*"))


def test_what_cannot_be_partitioned_by(spark, tmp_path):
    df = spark.range(1).selectExpr("id", "array(id) AS a")
    for columns in (["a"], ["nope"], ["id", "id"]):
        with pytest.raises(ValueError):
            write_dataset(df, str(tmp_path / "x"), partition_by=columns)
    with pytest.raises(ValueError):
        write_dataset(spark.sql("SELECT 1 AS a, 2 AS A"), str(tmp_path / "x"))

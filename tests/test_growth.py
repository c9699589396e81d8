"""Tasks grow in number with the rows, not in size."""

import re
import uuid

from pyspark.sql import functions as F

from tripflow.operators import bronze, profile
from tripflow.plans import medallion
from tripflow.session import scratch_path
from tripflow.sources import landing


def trips(spark, n):
    """Trips of five years, each there twice, every tenth without a dropoff."""
    k = F.col("id") % (n // 2)
    out = F.to_timestamp(F.lit("1995-06-01")) + F.make_dt_interval(days=k * 1700 / n, mins=k % 60)
    return spark.range(n).select(
        (k % 3).alias("VendorID"), out.alias("tpep_pickup_datetime"), F.when(k % 10 > 0, out).alias("tpep_dropoff_datetime"),
        F.when(k % 7 > 0, k.cast("double")).alias("fare_amount"), F.col("id").cast("string").alias("note"))


def test_landing_tasks_grow_with_rows(spark, monkeypatch):
    """No file holds more than about its share; copies share a file."""
    monkeypatch.setattr(medallion, "ROWS_A_TASK", 200)
    df = trips(spark, 6000)
    path = medallion.land_files(df, scratch_path(spark, "landing"), files=2)
    got = spark.read.parquet(path).withColumn("file", F.input_file_name())
    assert got.drop("year", "file").exceptAll(df).count() == 0 and got.count() == 6000
    assert max(r["count"] for r in got.groupBy("file").count().collect()) <= 3 * 200
    copies = got.groupBy(*bronze.DEDUP_KEYS).agg(F.count_distinct("file").alias("files"), F.count("*").alias("n"))
    assert copies.where("files > 1").count() == 0 and copies.where("n > 1").count() > 0


def test_landed_files_are_not_packed_into_few_tasks(spark):
    """A task of the load reads about one file, however many there are."""
    root = scratch_path(spark, f"packed-{uuid.uuid4().hex[:6]}")
    files = 5 * spark.sparkContext.defaultParallelism
    trips(spark, 4000).repartition(files).write.parquet(root)
    paths = [r.file_name for r in landing.landed_files(spark, root).collect()]
    df = landing.read_landing_files(spark, paths)
    tasks = df.groupBy(F.spark_partition_id().alias("task")).agg(F.count_distinct("source_file").alias("files"))
    assert tasks.agg(F.max("files")).first()[0] <= 2
    assert df.count() == 4000 and df.select("source_file").distinct().count() == files


def test_dedup_sorts_by_times_first(spark):
    """the first key that rows are sorted by has many values."""
    df = trips(spark, 100).withColumn("source_file", F.lit("f"))
    out = bronze.dedup_trips(df)
    text = out._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"SortAggregate\(key=\[(\w+?)#", text)
    assert keys and set(keys) == {"tpep_pickup_datetime"}
    assert out.columns == df.columns and out.count() == 50


def test_exact_distinct_copies_no_row(spark):
    """the same counts as side by side, without a copy of each row a column."""
    df = trips(spark, 500).withColumn("odd", F.when(F.col("VendorID") == 1, F.lit(float("nan"))).when(F.col("VendorID") == 2, F.lit(-0.0)).otherwise(F.lit(0.0))).withColumn("none", F.lit(None).cast("long"))
    got = profile.exact_distinct(df)
    assert "Expand" not in got._jdf.queryExecution().optimizedPlan().toString()
    side = df.agg(*[F.count_distinct(c).alias(c) for c in df.columns]).first().asDict()
    assert {r.column: r.distinct_values for r in got.collect()} == side

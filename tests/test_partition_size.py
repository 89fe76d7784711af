"""How much of a shuffle one task takes."""

from pyspark.sql import functions as F

from shelfbook.session import SETTINGS, tune


def test_a_task_takes_a_bounded_part_of_a_shuffle(spark):
    tune(spark)
    assert SETTINGS["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "8m"
    # 40 MB or so in 200 pieces, that a task of the default size would take in four tasks, one for each core
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        rows = spark.range(4_000_000).select(F.xxhash64("id").alias("a"), F.xxhash64("id", F.lit(1)).alias("b"))
        tasks = rows.join(rows.select("a"), "a").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert tasks > 4

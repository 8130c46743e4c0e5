import time

from pyspark.sql import functions as F

from corpusloom.llm.base import CLEANUP, park


def test_a_parked_result_leaves_no_shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {x for x in disk.getAllFiles().mkString(" ").split() if "/shuffle_" in x}
    before, set_to = shuffles(), spark.conf.get(CLEANUP, None)
    x = spark.range(5000).withColumn("k", F.col("id") % 7)
    rows = x.repartition(4, "id").join(x.groupBy("k").agg(F.count("*").alias("n")).repartition(3, "k"), "k")
    assert park(rows, "rows").count() == 5000
    until = time.time() + 5
    while (left := shuffles() - before) and time.time() < until:
        time.sleep(0.1)
    # the count's own shuffle may be there still
    assert len({x.rsplit("/shuffle_", 1)[1].split("_")[0] for x in left}) <= 1
    assert spark.conf.get(CLEANUP, None) == set_to

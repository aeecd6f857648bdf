"""A camera's documents stay as large as they are when the tables grow."""

from pyspark.sql import functions as F

from timeloom import composites


def test_documents_grow_in_number_alone(spark, tmp_path):
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        rows = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
        copies = spark.range(40).withColumnRenamed("id", "copy")
        rows.crossJoin(copies).withColumn(key, F.col(key) + F.col("copy") * 10_000).drop("copy").write.parquet(f"{tmp_path}/{name}.parquet")

    def longest(folder) -> list[int]:
        return [t.agg(F.max(F.length("text"))).first()[0] for t in composites.camera_tables(spark, str(folder))]

    assert all(big < 1.2 * small for big, small in zip(longest(tmp_path), longest("/root/testdata/sf0.001")))

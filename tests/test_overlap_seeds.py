"""The seeds of the best pairs of all don't grow with the vectors, and the pairs stay the same."""

from pyspark.sql import functions as F

from timeloom.operators import overlap, similarity


def test_seeds_are_few(spark, monkeypatch):
    monkeypatch.setattr(similarity.best_seeds, "__defaults__", (7,))
    rows = lambda shift: spark.range(60).select("id", F.timestamp_seconds(F.col("id") * 20_000 + shift).alias("start_at"), F.concat_ws(" ", F.lit("alpha"), F.concat(F.lit("beta"), F.col("id") % 9), F.concat(F.lit("gamma"), F.col("id") % 4)).alias("text"))
    sizes = {}

    def keep(df, name):
        sizes[name] = df.count()
        return df

    few = overlap.report(rows(0), rows(9_000), keep=keep).collect()
    assert sizes["seeds"] <= 7
    monkeypatch.setattr(similarity.best_seeds, "__defaults__", (100_000,))
    assert few == overlap.report(rows(0), rows(9_000)).collect() and len(few) == 12

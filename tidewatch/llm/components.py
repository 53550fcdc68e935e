"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import discard, scratch_path, stored


def connected(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """h, root: the least node that each linked node is connected with.

    Every round, nodes take the least label of their neighbours, pass it to the node they were labelled with, and then the
    label of their label; components of a long chain are done in rounds of the logarithm of its length. Labels are written
    to the shared folder every round, so lineage stays short; only the last ones stay there. Sums before every shuffle keep
    hubs cheap.
    """
    spark = links.sparkSession
    paths: list[str] = []

    def kept(df: DataFrame) -> DataFrame:
        paths.append(scratch_path(spark, "labels"))
        return stored(df, paths[-1])

    there = links.select(F.col(left).alias("h"), F.col(right).alias("other"))
    edges = kept(there.union(there.select("other", "h")).where("h <> other").distinct())
    labels = kept(edges.groupBy("h").agg(F.least("h", F.min("other")).alias("root")))
    while True:
        seen = edges.join(labels.withColumnRenamed("h", "other"), "other").groupBy("h").agg(F.min("root").alias("near"))
        heard = labels.join(seen, "h").select("h", "root", F.least("root", "near").alias("new"))
        hooked = heard.select(F.col("root").alias("h"), F.col("new").alias("hook")).groupBy("h").agg(F.min("hook").alias("hook"))
        joined = heard.join(hooked, "h", "left").select("h", F.col("root").alias("old"), F.least("new", F.coalesce("hook", "new")).alias("root"))
        joined = kept(joined)
        up = joined.select(F.col("h").alias("root"), F.col("root").alias("upper"))
        labels = kept(joined.join(up, "root", "left").select("h", "old", F.least("root", F.coalesce("upper", "root")).alias("root")))
        if not labels.where("old <> root").limit(1).count():
            discard(spark, paths[:-1])
            return labels.select("h", "root")
        labels = labels.select("h", "root")

"""Connected components of an edge table by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillflow.session import scratch_path


class Components:
    """Vertex labels that edges are added to, batch by batch; a label is the smallest id reached.

    Vertices without an edge are not stored: their label is their own id. Every step is written
    to the shared folder. In each pass every component hooks to its smallest smaller neighbour,
    so that the parents form a forest, and the forest is flattened by pointer jumping: the
    number of steps grows with the logarithm of a chain's length.
    """

    def __init__(self, spark):
        self.spark = spark
        self.labels = self._keep(spark.createDataFrame([], "id long, comp long"))

    def _keep(self, df: DataFrame) -> DataFrame:
        folder = scratch_path(self.spark, "components")
        df.write.parquet(folder)
        return self.spark.read.parquet(folder)

    def label(self, df: DataFrame, column: str, name: str) -> DataFrame:
        """``df`` with the component of the ids in ``column``."""
        known = self.labels.select(F.col("id").alias(column), F.col("comp").alias(name))
        joined = df.join(known, column, "left")
        return joined.withColumn(name, F.coalesce(name, column))

    def add(self, edges: DataFrame) -> int:
        """Add edges (a, b); returns how many components were joined to another."""
        edges = self._keep(edges.select("a", "b"))
        joined = 0
        while True:
            ends = self.label(self.label(edges, "a", "ca"), "b", "cb").where("ca <> cb")
            parents = self._keep(ends.groupBy(F.greatest("ca", "cb").alias("comp")).agg(
                F.min(F.least("ca", "cb")).alias("parent")))
            count = parents.count()
            if not count:
                return joined
            joined += count
            parents = self._flatten(parents)
            ids = self.labels.select("id", "comp").unionByName(
                parents.select(F.col("comp").alias("id"), "comp").join(
                    self.labels.select("id"), "id", "left_anti"))
            moved = ids.join(parents, "comp", "left").select(
                "id", F.coalesce("parent", "comp").alias("comp"))
            self.labels = self._keep(moved)

    def _flatten(self, parents: DataFrame) -> DataFrame:
        while True:
            above = parents.select(F.col("comp").alias("parent"), F.col("parent").alias("above"))
            jumped = self._keep(parents.join(above, "parent", "left").select(
                "comp", F.coalesce("above", "parent").alias("parent"),
                F.col("above").isNotNull().alias("moved")))
            parents = jumped.select("comp", "parent")
            if jumped.where("moved").isEmpty():
                return parents

"""Line dedup against levelled sorted runs of line hashes.

Every line of at least ``min_points`` code points (ends stripped of ASCII white space, A-Z
lower-cased) becomes a 16-byte hash. Batches come in document order. A run is a table of
(hash, owner), bucketed and sorted by hash. A new batch is shuffled by hash once and then
merge-anti-joined with every run, bucket by bucket and without moving the runs; what is left
over is new and becomes a run of level 0. When a level holds ``fan_in`` runs, they are merged
into one run of the next level, so a batch meets a logarithmic number of runs.

Defined results: a null text counts as empty, that is one empty line. Rows with the same
doc_id are one document holding all their lines. Null ids count as one last document. Ties
between documents of a batch go to the smallest id. An empty table gives an empty result.
Input columns stay; one named like an added column is replaced.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillflow.llm.frames import SPACE, ascii_lower, packed, text_of, unpacked
from tillflow.session import scratch_path


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def line_hashes(docs: DataFrame, id_col: str, text_col: str, min_points: int) -> DataFrame:
    """(hash, id, version, pos) of every line long enough; version tells texts of an id apart."""
    text = text_of(F.col(text_col))
    lines = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("version"),
        F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    keyed = lines.select("id", "version", "pos", line_key(F.col("line")).alias("key"))
    return keyed.where(F.char_length("key") >= min_points).select(
        F.unhex(F.md5("key")).alias("hash"), "id", "version", "pos")


class LineRuns:
    """The hashes seen so far, in levels of bucketed and sorted runs in the shared folder."""

    def __init__(self, spark: SparkSession, fan_in: int = 2):
        self.spark, self.fan_in = spark, fan_in
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]

    def _save(self, run: DataFrame, level: int) -> str:
        name = f"line_run_{level}_{uuid.uuid4().hex}"
        (run.write.format("parquet").bucketBy(self.buckets, "hash").sortBy("hash")
            .option("path", scratch_path(self.spark, name)).saveAsTable(name))
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        return name

    def compact(self) -> None:
        """Merge every full level into one run of the next."""
        level = 0
        while level < len(self.levels):
            if len(self.levels[level]) >= self.fan_in:
                full, self.levels[level] = self.levels[level], []
                merged = self.spark.table(full[0])
                for name in full[1:]:
                    merged = merged.unionByName(self.spark.table(name))
                self._save(merged.repartition(self.buckets, "hash"), level + 1)
                self._drop(full)
            level += 1

    def add(self, lines: DataFrame) -> DataFrame:
        """Add a batch of line hashes; returns its lines that are to go, by id and version."""
        self.compact()
        fresh = lines.groupBy("hash").agg(F.min("id").alias("owner"))
        for level in self.levels:
            for name in level:
                fresh = fresh.join(self.spark.table(name).hint("merge"), "hash", "left_anti")
        run = self._save(fresh, 0)
        # Read by path, not as a bucketed table: AQE may then split a very common line.
        # A run without new lines has no file to take a schema from.
        owners = self.spark.read.schema(fresh.schema).parquet(self._path(run)).withColumn(
            "new", F.lit(True))
        return lines.join(owners, "hash", "left").where(
            F.col("new").isNull() | ~F.col("id").eqNullSafe(F.col("owner"))
        ).select("id", "version", "pos")

    def _drop(self, names: list[str]) -> None:
        """Take runs out of the catalog; their files stay in the shared folder for the cluster."""
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def close(self) -> None:
        """No more batches: no run is left in the catalog."""
        self._drop([name for level in self.levels for name in level])
        self.levels = [[]]

    def _path(self, name: str) -> str:
        detail = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
        return detail.where(F.col("col_name") == "Location").first()["data_type"]


def id_slices(docs: DataFrame, id_col: str, batches: int) -> Column:
    """Number of the batch of a row: slices of about equal size in order of id, nulls last."""
    at = [i / batches for i in range(1, batches)]
    cuts = docs.agg(F.percentile_approx(id_col, at, 1000).alias("cuts")).first()["cuts"] or []
    later = [F.when(F.col("id") > F.lit(c), 1).otherwise(0) for c in cuts]
    number = sum(later, F.lit(0)) if later else F.lit(0)
    return F.when(F.col("id").isNull(), F.lit(batches - 1)).otherwise(number)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_points: int = 10, batches: int = 4, fan_in: int = 2) -> DataFrame:
    """Keep every long line only in the first document (by id) that holds it.

    Adds ``n_lines``, ``n_dropped`` and ``kept_text``. The documents are read twice: once for
    the hashes, which are written by batch, and once for the result.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "line-hashes")
    hashes = line_hashes(docs, id_col, text_col, min_points)
    if batches > 1:
        hashes = hashes.withColumn("batch", id_slices(docs, id_col, batches))
    else:
        hashes = hashes.withColumn("batch", F.lit(0))
    schema = hashes.schema
    hashes.write.partitionBy("batch").parquet(folder)
    written = spark.read.schema(schema).parquet(folder)

    runs = LineRuns(spark, fan_in)
    gone = None
    for batch in range(batches):
        lost = runs.add(written.where(F.col("batch") == batch).drop("batch"))
        gone = lost if gone is None else gone.unionByName(lost)
    runs.close()   # what goes is read from the files of the runs
    gone = gone.groupBy("id", "version").agg(F.sort_array(F.collect_set("pos")).alias("gone"))

    text = text_of(F.col(text_col))
    rows = packed(docs, id=F.col(id_col), version=F.xxhash64(text), text=text).alias("d")
    joined = rows.join(gone.alias("g"), F.col("d.id").eqNullSafe(F.col("g.id"))
                       & (F.col("d.version") == F.col("g.version")), "left")
    lines = joined.select("row", "text", F.split("text", "\n", -1).alias("lines"), "gone")
    # Kept lines are the stretches between lines that go: linear in the number of lines.
    stretches = F.expr("""array_join(flatten(transform(sequence(0, size(gone)), i -> slice(lines,
        if(i = 0, 0, gone[i - 1] + 1) + 1,
        if(i = size(gone), size(lines), gone[i]) - if(i = 0, 0, gone[i - 1] + 1)))), '\n')""")
    return unpacked(
        lines, docs.columns,
        n_lines=F.size("lines").cast("long"),
        n_dropped=F.coalesce(F.size("gone"), F.lit(0)).cast("long"),
        kept_text=F.when(F.col("gone").isNull(), F.col("text")).otherwise(stretches))


def cleaned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            size_col: str = "n_chars") -> DataFrame:
    """The same columns with the kept lines as text and its code points as size."""
    done = dedup_lines(docs.withColumns({"kept row": F.struct("*")}), id_col, text_col)
    row = F.col("kept row")
    changed = {text_col: F.col("kept_text"),
               size_col: F.char_length("kept_text").cast(
                   docs.schema[size_col].dataType if size_col in docs.columns else "long")}
    return done.select(*[changed.get(c, row.getField(c)).alias(c) for c in docs.columns])

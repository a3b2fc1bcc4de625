"""Star-schema tables saved as Parquet below one root folder.

Small tables are kept in versions: a version is a folder, and a commit (see ``CommitLog``) names
the current ones. Readers see the old version or the new one and never a half of it; superseded
folders stay for ``KEPT_VERSIONS`` commits of their table. The fact is partitioned by day and
rewritten day by day; its partial aggregates by day follow every write.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tillflow.operators.day_totals import day_rows, store_bitmaps, with_codes
from tillflow.operators.dimensions import seed_retailer
from tillflow.operators.facts import WATERMARK, latest_per_key, merge_fact, merge_few
from tillflow.operators.merge import greatest_leads, leading_rows
from tillflow.schemas import ETL_METADATA, FACT_KEY, SIDE_TABLES, TABLES, conform, evolved
from tillflow.session import scratch_path
from tillflow.sources.commits import CommitLog, Conflict

FACT, STATE = "fact_sales", "etl_metadata"
BY_DAY = (FACT, "fact_day_stores")
LAYOUTS = {**TABLES, **SIDE_TABLES}
KEPT_VERSIONS = 3
# Rows of a batch that may be sent to all tasks: about 20 MB.
FEW_ROWS = 200_000
# Not part of what a version holds: a row that was only seen again is no change.
UNCOUNTED = ("updated_at",)


def content_sums(rows: DataFrame) -> list[Column]:
    """The number of rows and two sums of 64-bit row hashes, whatever the order of the rows.

    Equal contents have equal sums; unequal ones share them with a chance of about 2 ** -128.
    """
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns if c not in UNCOUNTED]))
    sums = [F.coalesce(F.sum(F.xxhash64(F.lit(salt), text).cast("decimal(20,0)")), F.lit(0))
            for salt in (1, 2)]
    return [column.alias(f"sum_{i}") for i, column in enumerate((F.count(F.lit(1)), *sums))]


class SavedTables:
    """Reads and writes the tables."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/_commits")
        self._read_at: dict[str, str | None] = {}   # the version that was last read, by table

    # Versions

    def _entry(self, content: dict, name: str) -> dict:
        return content.get("tables", {}).get(name, {})

    def path(self, name: str) -> str:
        """The folder of a table; of a versioned one that of its current version."""
        return self._folder(self.log.head()[1], name)

    def _folder(self, content: dict, name: str) -> str:
        return f"{self.root}/{self._entry(content, name).get('folder', name)}"

    def _layout(self, content: dict, name: str) -> T.StructType:
        saved = self._entry(content, name).get("schema")
        return evolved(LAYOUTS[name], T.StructType.fromDDL(saved)) if saved else LAYOUTS[name]

    def layout(self, name: str) -> T.StructType:
        """The columns of a table, with those that were added to it; no data file is opened."""
        return self._layout(self.log.head()[1], name)

    def read(self, name: str) -> DataFrame:
        content = self.log.head()[1]
        if name == STATE:
            return self._state_rows(content)
        self._read_at[name] = self._entry(content, name).get("folder")
        return self.spark.read.schema(self._layout(content, name)).parquet(
            self._folder(content, name))

    def star(self) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in TABLES}

    def star_with_totals(self) -> dict[str, DataFrame]:
        """The star schema and the partial aggregates of its fact, from which reports take what they can."""
        return self.star() | {name: self.read(name) for name in ("fact_days", "fact_day_stores")}

    def create(self, created_at: dt.date | None = None) -> None:
        """Empty tables where there are none, and the seed retailer.

        Tables that stand in their plain folders, as earlier versions of this library saved
        them, are taken over as they are.
        """
        content = self.log.head()[1]
        fresh = {}
        for name, schema in LAYOUTS.items():
            if name == STATE or self._entry(content, name):
                continue
            folder = f"{self.root}/{name}"
            if name in BY_DAY or not self.log.exists(folder):
                writer = self.spark.createDataFrame([], schema).write.mode("ignore")
                (writer.partitionBy("date") if name in BY_DAY else writer).parquet(folder)
            fresh[name] = {"folder": name}
        if fresh:
            self._commit(lambda held: {**held, "tables": {**held.get("tables", {}), **fresh}})
        if self.log.exists(f"{self.root}/{STATE}") and "state" not in self.log.head()[1]:
            saved = self.spark.read.schema(ETL_METADATA).parquet(f"{self.root}/{STATE}")
            self.set_watermark(saved.where(F.col("key") == WATERMARK))
        self.replace("dim_retailer", seed_retailer(self.read("dim_retailer"), created_at))

    def _commit(self, change, tries: int = 20) -> None:
        """Commit what ``change`` makes of the present content, as often as others come first."""
        for left in range(tries, 0, -1):
            number, content = self.log.head()
            try:
                self.log.commit(number, change(content))
                return
            except Conflict:
                if left == 1:
                    raise

    def replace(self, name: str, rows: DataFrame) -> bool:
        """Give a small table new rows; False if they are the present ones."""
        return bool(self.replace_all({name: rows}))

    def replace_all(self, tables: dict[str, DataFrame]) -> list[str]:
        """Give several small tables new rows in one commit; returns those that changed.

        Rows may derive from the present version, which stays until later ones supersede it.
        A table whose content is the present one, but for the time of its last update, keeps
        its version: rows are computed once, their digest is taken while they are written, and
        the copy goes. A table that another writer has replaced since it was read here raises a
        ``Conflict``, and none of the tables changes.
        """
        content = self.log.head()[1]
        based = {n: self._read_at.get(n, self._entry(content, n).get("folder")) for n in tables}
        rows = {n: conform(df, evolved(LAYOUTS[n], self._layout(content, n), df))
                for n, df in tables.items()}
        new = {}
        for name, df in rows.items():
            entry = self._entry(content, name)
            # Added columns that hold nothing yet are part of the layout, not of the digest.
            schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
            folder = f"{name}/version-{uuid.uuid4().hex}"
            held = Observation()
            df.observe(held, *content_sums(df)).write.parquet(f"{self.root}/{folder}")
            digest = "/".join(str(held.get[f"sum_{i}"]) for i in range(3))
            if entry.get("digest") == digest and entry.get("schema", schema) == schema:
                self.log.remove(f"{self.root}/{folder}")
                continue
            new[name] = {"folder": folder, "digest": digest, "schema": schema}
        if not new:
            return []
        superseded: list[str] = []

        def swap(held: dict) -> dict:
            superseded.clear()
            changed = {}
            for name, entry in new.items():
                present = self._entry(held, name)
                if present.get("folder") != based[name]:
                    raise RuntimeError(f"{name} was replaced by another writer")
                older = [*present.get("older", []), present.get("folder")]
                superseded.extend(older[:-KEPT_VERSIONS])
                changed[name] = {**entry, "older": older[-KEPT_VERSIONS:]}
            return {**held, "tables": {**held.get("tables", {}), **changed}}

        self._commit(swap)
        for name, entry in new.items():
            self._read_at[name] = entry["folder"]
        for folder in superseded:
            # A plain folder holds the versions of its table, too.
            if folder and "/" in folder:
                self.log.remove(f"{self.root}/{folder}")
        return list(new)

    def add_columns(self, name: str, ddl: str) -> None:
        """Add columns to a table's layout, or widen those that were added; rows show them as null."""
        added = T.StructType.fromDDL(ddl)

        def widen(held: dict) -> dict:
            layout = evolved(LAYOUTS[name], self._layout(held, name), added)
            text = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in layout.fields)
            entry = {"folder": name, **self._entry(held, name), "schema": text}
            return {**held, "tables": {**held.get("tables", {}), name: entry}}

        self._commit(widen)

    # The fact

    def write_days(self, rows: DataFrame, days: list[dt.date] | None = None,
                   in_place: bool = False) -> None:
        """Replace the days that occur in ``rows``; other days stay as they are.

        The overwrite mode is set on the write itself: in the session default, the same
        write would delete every other day. Rebalancing splits a busy day over several
        tasks and files, and joins quiet days; with ``in_place`` the rows are written by the
        tasks that have read them. The partial aggregates follow; until they do, the days are
        noted as open, so that a write that is broken off can be made good. ``days`` are those
        that occur, if they are known.
        """
        rows = conform(rows, TABLES[FACT])
        if not set(rows.columns) <= set(self.layout(FACT).names):
            held = self.layout(FACT).names
            self.add_columns(FACT, ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                                             for f in rows.schema.fields if f.name not in held))
        if days is not None:
            self._open_days({str(d) for d in days})
        span = Observation()
        rows = conform(rows, self.layout(FACT))
        (
            (rows if in_place else rows.hint("rebalance", "date"))
            .observe(span, F.min("date").alias("first"), F.max("date").alias("last"))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("date").parquet(f"{self.root}/{FACT}")
        )
        first, last = span.get["first"], span.get["last"]
        if first is None:
            self._open_days(set(), closed={str(d) for d in days or []})
            return
        touched = F.col("date").isin(days) if days else F.col("date").between(first, last)
        self._refresh(touched)
        if days is not None:
            self._open_days(set(), closed={str(d) for d in days})

    def _open_days(self, opened: set[str], closed: set[str] = frozenset()) -> None:
        def note(held: dict) -> dict:
            return {**held, "open_days": sorted((set(held.get("open_days", [])) | opened) - closed)}

        if opened or closed:
            self._commit(note)

    def repair_days(self) -> list[dt.date]:
        """Make good the aggregates of days whose write was broken off; returns the days."""
        noted = self.log.head()[1].get("open_days", [])
        days = [dt.date.fromisoformat(d) for d in noted]
        if days:
            self._refresh(F.col("date").isin(days))
            self._open_days(set(), closed=set(noted))
        return days

    def _refresh(self, touched) -> None:
        """Aggregate the days of the fact that ``touched`` tells anew."""
        fact = self.read(FACT).where(touched)
        held = self.read("sku_codes")
        codes = with_codes(held, fact)
        if codes is not held:
            self.replace("sku_codes", codes)
        store_bitmaps(fact, self.read("sku_codes")).hint("rebalance", "date").write.mode(
            "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(
            f"{self.root}/fact_day_stores")
        kept = self.read("fact_days").where(~touched)
        self.replace("fact_days", kept.unionByName(day_rows(fact)))

    def upsert_fact(self, batch: DataFrame, order: str, loaded_on: dt.date | None = None) -> None:
        """Merge a batch into its days; the last row per key in ``order`` counts.

        The batch is read several times, so hand in a saved one. Only its days are read and
        rewritten. Their list is no longer than the calendar and prunes the fact's partitions
        before any file is opened. A batch of at most FEW_ROWS is sent to the held rows, which
        are not shuffled; a larger one meets them in a full join. Where it holds at most FEW_ROWS
        keys, only the rows that can be the last of their key are sorted.
        """
        self.repair_days()
        counts = batch.groupBy("date").count().collect()   # at most one row for each day
        days = [r["date"] for r in counts]
        few = sum(r["count"] for r in counts) <= FEW_ROWS
        current = self.read(FACT).filter(F.col("date").isin(days))
        merge = merge_few if few else merge_fact
        leads = None if few else greatest_leads(batch, FACT_KEY, order)
        if leads is not None:
            folder = scratch_path(self.spark, "leads")
            leads.write.parquet(folder)
            leads = self.spark.read.parquet(folder)
            if leads.count() <= FEW_ROWS:
                batch = leading_rows(batch, leads, FACT_KEY, order)
        self.write_days(merge(current, latest_per_key(batch, order), loaded_on), days, few)

    # State

    def _state_rows(self, content: dict) -> DataFrame:
        rows = [(key, s["value"], s["updated_at"] and dt.datetime.fromisoformat(s["updated_at"]))
                for key, s in content.get("state", {}).items()]
        return self.spark.createDataFrame(rows, ETL_METADATA)

    def watermark(self) -> dt.date | None:
        state = self.log.head()[1].get("state", {}).get(WATERMARK)
        return dt.date.fromisoformat(state["value"]) if state else None

    def set_watermark(self, row: DataFrame) -> None:
        """Store a state row unless a later date is stored; an empty frame changes nothing.

        The later of two dates stays whichever writer comes first: one whose commit is taken
        by another reads the state anew.
        """
        given = [(r["key"], {"value": r["value"], "updated_at": r["updated_at"]
                             and r["updated_at"].isoformat()}) for r in conform(
                                 row, ETL_METADATA).collect()]

        def later(held: dict) -> dict:
            state = dict(held.get("state", {}))
            for key, new in given:
                old = state.get(key)
                if old is None or (old["value"], old["updated_at"] or "") < (
                        new["value"], new["updated_at"] or ""):
                    state[key] = new
            return {**held, "state": state}

        if given and later(self.log.head()[1]) != self.log.head()[1]:
            self._commit(later)

    def withdraw_watermark(self) -> dt.date | None:
        """Take back the last change of the watermark; returns the mark that holds again.

        The commits that are kept tell the marks before; the withdrawal is a commit itself.
        """
        marks = [r["mark"] for r in self.state_history().where(
            F.col("key") == WATERMARK).orderBy("number").collect()]
        present = self.watermark()
        earlier = [m for m in marks if m is None or m < present] if present else []
        mark = max((m for m in earlier if m), default=None)

        def back(held: dict) -> dict:
            state = {k: v for k, v in held.get("state", {}).items() if k != WATERMARK}
            if mark:
                state[WATERMARK] = {"value": str(mark), "updated_at": None}
            return {**held, "state": state}

        if present:
            self._commit(back)
        return mark

    def state_history(self) -> DataFrame:
        """(number, key, mark, updated_at): the watermark after each commit that changed it."""
        rows = self.log.history().select(
            "number", F.from_json("content", "state map<string,struct<value:string,"
                                  "updated_at:string>>").alias("c")).select(
            "number", F.explode("c.state").alias("key", "s"))
        marks = rows.select("number", "key", F.col("s.value").cast("date").alias("mark"),
                            F.to_timestamp("s.updated_at").alias("updated_at"))
        return marks.groupBy("key", "mark", "updated_at").agg(F.min("number").alias("number")).select(
            "number", "key", "mark", "updated_at")

    def register(self, database: str) -> None:
        """Declare the saved tables in the catalog, so that views can name them.

        A versioned table is declared in its present version: register again after a load.
        """
        for name in (*TABLES, "fact_days", "fact_day_stores"):
            self.spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
            if name == STATE:
                folder = scratch_path(self.spark, "state")
                self.read(name).write.parquet(folder)
            else:
                folder = self.path(name)
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                                for f in self.layout(name))
            parts = " PARTITIONED BY (date)" if name in BY_DAY else ""
            self.spark.sql(f"CREATE TABLE {database}.{name} ({columns}) USING parquet{parts} "
                           f"LOCATION '{folder}'")
            if parts:
                self.spark.catalog.recoverPartitions(f"{database}.{name}")


def describe_catalog(spark: SparkSession, database: str = "default") -> DataFrame:
    """Tables and views of a database with their columns, one row per column.

    Temporary views are listed with any database but lie in none, so they are left out.
    """
    rows = [
        (t.name, t.tableType, i, c.name, c.dataType)
        for t in spark.catalog.listTables(database) if not t.isTemporary
        for i, c in enumerate(spark.catalog.listColumns(f"{database}.{t.name}"), start=1)
    ]
    return spark.createDataFrame(
        rows, "table_name string, table_type string, ordinal int, column_name string, "
              "data_type string",
    ).orderBy("table_name", "ordinal")

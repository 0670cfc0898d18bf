"""The star schema as Parquet directories.

Every write is staged, checked and then published. Staged rows lie in a folder
of their own until NOT NULL, lengths and keys have been checked; a violation
leaves the table as it was. A marker file then declares them ready and their
directories are moved into place. If a run dies while moving, the next write
(or ``recover``) finishes the moves; without the marker the staged rows are
thrown away. A month that has begun is staged whole, so nothing is ever read
from what is being replaced. Marks move only after the data is stored.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.incremental import FIRST_MARK, SEED_MARK
from tidemark.operators.quality import check_observed, duplicate_keys, violation_counts
from tidemark.schemas import BY_MONTH, ENTITY_MARKS, FILE_LEDGER, TABLES, Table, conform
from tidemark.scratch import stored
from tidemark.sources.seeds import initial_marks, labour_series
from tidemark.storage import Folders

MARKS = "latest_data"
_STAGED = "_staged"
_WHOLE, _PARTS = "_READY_WHOLE", "_READY_PARTS"
_NOTHING = "_NOTHING_LEFT"


@dataclass(frozen=True)
class Warehouse:
    """Tables under one root directory, used with one session and one writer at a time."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    # -- tables -----------------------------------------------------------

    def reset(self, names: Iterable[str] = tuple(TABLES)) -> None:
        """The named tables empty again with their first marks, the series dimension seeded.

        Other tables and their marks stay.
        """
        names = set(names)
        known = Folders(self.spark).exists(self.path(MARKS)) and MARKS not in names
        marks = self.marks() if known else {}
        for name in names - {MARKS}:
            rows = labour_series(self.spark) if name == "bol_series_dim" else None
            self.replace(name, self.spark.createDataFrame([], TABLES[name].schema) if rows is None else rows)
            for side in (ENTITY_MARKS, FILE_LEDGER):
                Folders(self.spark).remove(f"{self.path(side.name)}/table_name={name}")
        seeds = {row["table_name"]: SEED_MARK for row in initial_marks(self.spark).collect()}
        kept = {mark: day for mark, day in marks.items() if mark.partition(":")[0] not in names}
        self._write_marks(seeds | kept)

    def read(self, name: str, after: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
        """S3: a table, or its rows in ``(after, until]`` read from the directories that hold them."""
        table = TABLES[name]
        df = self.spark.read.schema(table.stored_schema).parquet(self.path(name))
        if after is not None:
            df = df.filter(F.col("date") > after)
        if until is not None:
            df = df.filter(F.col("date") <= until)
        if table.layout == BY_MONTH:
            month = F.col("year") * 100 + F.col("month")
            if after is not None:
                df = df.filter(month >= after.year * 100 + after.month)
            if until is not None:
                df = df.filter(month <= until.year * 100 + until.month)
        return df.select(*table.schema.names)

    def register_views(self, names: Iterable[str] = tuple(TABLES)) -> None:
        """The tables as temporary views of their own names, for SQL."""
        for name in names:
            self.read(name).createOrReplaceTempView(name)

    def load(self, name: str, new: DataFrame) -> dict[str, object]:
        """The dates of the given rows are replaced by them, others stay.

        A repeated load changes nothing. Where a directory is a month, the
        stored days of it that did not come are staged beside the new ones.
        """
        if not TABLES[name].layout:
            raise ValueError(f"{name} has no directories to load; replace it")
        return self._staged(TABLES[name], conform(new, name), _PARTS)

    def merge(
        self, name: str, new: DataFrame, identity: Sequence[str], gone: DataFrame | None = None
    ) -> dict[str, object]:
        """K1 by key: given rows replace stored ones of the same identity, all others stay.

        Whole directories are still what is staged and published: the stored
        rows of the touched ones that did not come are staged beside the new
        ones. Stored rows that match ``gone`` by all its columns leave the table
        unless they come again. A repeated merge changes nothing.
        """
        if not TABLES[name].layout:
            raise ValueError(f"{name} has no directories to merge into; replace it")
        return self._staged(TABLES[name], conform(new, name), _PARTS, (tuple(identity), gone))

    def add_years(self, name: str, new: DataFrame) -> dict[str, object]:
        """U1, K1 for a table laid out by year: the stored rows of the touched years and the new ones, once each."""
        self.recover(name)
        rows = conform(new, TABLES[name])
        touched = self.read(name).join(rows.select("year").distinct(), "year", "left_semi")
        return self._staged(TABLES[name], conform(touched, name).unionByName(rows).distinct(), _PARTS)

    def replace(self, name: str, df: DataFrame) -> dict[str, object]:
        """K2, K3: new content under the declared schema; the rows may come from the table itself."""
        return self._staged(TABLES[name], conform(df, name), _WHOLE)

    def _staged(
        self, table: Table, rows: DataFrame, kind: str, merged: tuple[Sequence[str], DataFrame | None] | None = None
    ) -> dict[str, object]:
        self.recover(table.name)
        observed = Observation()
        counts = violation_counts(table.required, table.lengths)
        if "date" in table.schema.names:
            counts += [F.max("date").alias("max_date"), F.min("date").alias("min_date")]
        folder = f"{self.path(_STAGED)}/{table.name}-{uuid.uuid4().hex}"
        self._write(table, rows, folder, lambda spread: spread.observe(observed, *counts))
        found = observed.get
        check_observed(table, found)
        staged = self.spark.read.schema(table.stored_schema).parquet(folder)
        if merged is not None:
            staged = self._beside(table, folder, staged, found, *merged)
        elif kind == _PARTS and table.layout == BY_MONTH and found["n_rows"]:
            edge, last = found["min_date"].replace(day=1) - dt.timedelta(days=1), found["max_date"]
            end = (last.replace(day=1) + dt.timedelta(days=31)).replace(day=1) - dt.timedelta(days=1)
            months = staged.select(F.trunc("date", "MM").alias("_month")).distinct()
            begun = self.read(table.name, after=edge, until=end).withColumn("_month", F.trunc("date", "MM"))
            begun = begun.join(months, "_month", "left_semi").join(staged.select("date").distinct(), "date", "left_anti")
            kept = conform(begun, table)
            if not kept.isEmpty():
                self._write(table, stored(kept, "begun"), folder)  # reads the staging folder, so not straight into it
                staged = self.spark.read.schema(table.stored_schema).parquet(folder)
        if table.key and found["n_rows"]:
            twice = duplicate_keys(staged, table.key).first()
            if twice is not None:
                raise ValueError(f"{table.name}: key that occurs more than once: {twice.asDict()}")
        folders = Folders(self.spark)
        folders.mark(f"{folder}/{kind}")
        self._publish(folders, table.name, folder)
        return found

    def _beside(
        self,
        table: Table,
        folder: str,
        staged: DataFrame,
        found: dict[str, object],
        identity: Sequence[str],
        gone: DataFrame | None,
    ) -> DataFrame:
        """Add to a staging folder what stays of the directories that its rows touch; all that is staged then."""
        day = F.trunc("date", "MM") if table.layout == BY_MONTH else F.col("date")
        touched = staged.select(day.alias("_part"))
        if gone is None:
            if not found["n_rows"]:
                return staged
            low, high = found["min_date"].replace(day=1), found["max_date"]
            end = (high.replace(day=1) + dt.timedelta(days=31)).replace(day=1) - dt.timedelta(days=1)
            stored_rows = self.read(table.name, after=low - dt.timedelta(days=1), until=end)
        else:
            stored_rows = self.read(table.name)
            leaving = stored_rows.join(gone.distinct(), gone.columns, "left_semi").select("date", day.alias("_part"))
            leaving = stored(leaving.distinct(), "leaving")  # a row per day at most
            touched = touched.union(leaving.select("_part"))
            edge = leaving.agg(F.min("date").alias("low"), F.max("date").alias("high")).first()
            for name, choose, value in (("min_date", min, edge.low), ("max_date", max, edge.high)):
                found[name] = choose((d for d in (found[name], value) if d is not None), default=None)
        touched = stored(touched.distinct(), "touched")
        stays = stored_rows.withColumn("_part", day).join(touched, "_part", "left_semi")
        stays = stays.join(staged.select(*identity).distinct(), list(identity), "left_anti")
        if gone is not None:
            stays = stays.join(gone.distinct(), gone.columns, "left_anti")
        kept = stored(conform(stays, table), "stays")
        if not kept.isEmpty():
            self._write(table, kept, folder)
        whole = self.spark.read.schema(table.stored_schema).parquet(folder)
        if gone is not None:
            left = touched.join(whole.select(day.alias("_part")).distinct(), "_part", "left_anti")
            for (part,) in left.collect():  # days or months that nothing is left of
                below = f"year={part.year}/month={part.month}" if table.layout == BY_MONTH else f"date={part}"
                Folders(self.spark).mark(f"{folder}/{below}/{_NOTHING}")
        return whole

    def _write(self, table: Table, rows: DataFrame, folder: str, watch=lambda df: df) -> None:
        """Add rows to a staging folder: few files per directory, a large directory still written by many tasks."""
        if table.layout == BY_MONTH:
            day = F.col("date")
            rows = rows.withColumns({"year": F.year(day), "month": F.month(day)})
        spread = rows.hint("rebalance", *table.layout) if table.layout else rows
        writer = watch(spread).write.mode("append")
        (writer.partitionBy(*table.layout) if table.layout else writer).parquet(folder)

    def _publish(self, folders: Folders, name: str, folder: str) -> None:
        if folders.exists(f"{folder}/{_WHOLE}"):
            folders.move(folder, self.path(name))
            return
        for part in folders.names(folder):
            if "=" in part:  # a date, a year, or a year with its months
                for below in [b for b in folders.names(f"{folder}/{part}") if "=" in b] or [""]:
                    moved = f"{part}/{below}".rstrip("/")
                    folders.move(f"{folder}/{moved}", f"{self.path(name)}/{moved}")
        folders.remove(folder)

    def recover(self, name: str | None = None) -> None:
        """Finish what an earlier run had declared ready; drop what it had not."""
        folders = Folders(self.spark)
        for staged in folders.names(self.path(_STAGED)):
            of = staged.rpartition("-")[0]
            if name in (None, of):
                folder = f"{self.path(_STAGED)}/{staged}"
                if any(folders.exists(f"{folder}/{kind}") for kind in (_WHOLE, _PARTS)):
                    self._publish(folders, of, folder)
                else:
                    folders.remove(folder)

    # -- what is known of inputs -------------------------------------------

    def _side(self, table: Table, name: str) -> DataFrame:
        self.recover(table.name)
        if not Folders(self.spark).exists(f"{self.path(table.name)}/table_name={name}"):
            return self.spark.createDataFrame([], table.schema)
        return self.spark.read.schema(table.schema).parquet(self.path(table.name)).filter(F.col("table_name") == name)

    def _set_side(self, table: Table, name: str, rows: DataFrame) -> None:
        """The rows of one table replaced; they may come from those before."""
        known = conform(rows.withColumn("table_name", F.lit(name)), table)
        self._staged(table, stored(known, table.name), _PARTS)

    def entity_marks(self, name: str) -> DataFrame:
        """(entity, latest): the largest date that each entity of a table has been loaded to."""
        return self._side(ENTITY_MARKS, name).select("entity", "latest")

    def raise_entity_marks(self, name: str, latest: DataFrame) -> None:
        """Marks by entity go up to (entity, latest); entities that do not come keep theirs."""
        both = self.entity_marks(name).unionByName(latest.select("entity", "latest"))
        self._set_side(ENTITY_MARKS, name, both.groupBy("entity").agg(F.max("latest").alias("latest")))

    def ledger(self, name: str) -> DataFrame:
        """The file versions that a table has been loaded from."""
        return self._side(FILE_LEDGER, name).drop("table_name")

    def note_files(self, name: str, files: DataFrame) -> None:
        """Versions of files that have been read, in place of earlier versions of the same files."""
        others = self.ledger(name).join(files.select("file"), "file", "left_anti")
        self._set_side(FILE_LEDGER, name, others.unionByName(files.select(*others.columns)))

    # -- high-water marks -------------------------------------------------

    def marks(self) -> dict[str, dt.date]:
        """The mark of every table, in one action. The table has a row per table and is replaced as a whole."""
        self.recover(MARKS)
        df = self.spark.read.schema(TABLES[MARKS].schema).parquet(self.path(MARKS))
        latest = df.groupBy("table_name").agg(F.to_date(F.max("latest_date")).alias("latest"))
        return {row["table_name"]: row["latest"] for row in latest.collect()}

    def mark(self, name: str) -> dt.date:
        """The mark of one table."""
        return self.marks().get(name, FIRST_MARK)

    def set_mark(self, name: str, latest: dt.date) -> None:
        """Call after the data is stored."""
        self.set_marks({name: latest})

    def set_marks(self, latest: Mapping[str, dt.date]) -> None:
        """Several marks at once."""
        self._write_marks(self.marks() | dict(latest))

    def _write_marks(self, marks: Mapping[str, dt.date]) -> None:
        rows = [(name, dt.datetime.combine(day, dt.time())) for name, day in sorted(marks.items())]
        df = self.spark.createDataFrame(rows, TABLES[MARKS].schema)
        self.replace(MARKS, df.coalesce(1))

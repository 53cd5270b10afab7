"""Versioned tables on plain Parquet.

``write`` puts the data of a new version into a fresh folder and appends one row to the table's log after the data
is complete. Readers go by the log alone, so they never see a half-written version and an older version stays
readable by its id.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strideframe.sources.files import read_json_lines
from strideframe.sources.small import literal_table

LOG_SCHEMA = "snapshot_id long, committed_at string, operation string, rows long, path string"


@dataclass(frozen=True)
class Commit:
    snapshot_id: int
    committed_at: str
    operation: str
    rows: int
    path: str


class SnapshotStore:
    """Tables named ``namespace.table`` (or longer) below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def location(self, table: str) -> str:
        return "/".join([self.root, *table.split(".")])

    def log(self, table: str) -> DataFrame:
        """Commits, empty when the table was never written."""
        try:
            return read_json_lines(self.spark, f"{self.location(table)}/log", LOG_SCHEMA)
        except FileNotFoundError:
            return literal_table(self.spark, [], LOG_SCHEMA)

    def recent(self, table: str, limit: int = 5) -> DataFrame:
        return self.log(table).orderBy(F.desc("committed_at"), F.desc("snapshot_id")).limit(limit)

    def latest(self, table: str) -> Commit | None:
        rows = self.recent(table, 1).collect()
        return Commit(**rows[0].asDict()) if rows else None

    def latest_id(self, table: str) -> int | None:
        commit = self.latest(table)
        return commit.snapshot_id if commit else None

    def exists(self, table: str) -> bool:
        return self.latest(table) is not None

    def read(self, table: str, as_of: int | None = None) -> DataFrame:
        if as_of is None:
            commit = self.latest(table)
        else:
            rows = self.log(table).where(F.col("snapshot_id") == as_of).limit(1).collect()
            commit = Commit(**rows[0].asDict()) if rows else None
        if commit is None:
            raise FileNotFoundError(f"table {table} has no snapshot" + (f" {as_of}" if as_of is not None else ""))
        return self.spark.read.parquet(commit.path)

    def read_optional(self, table: str) -> DataFrame | None:
        """The table, or None when it was never written; any other failure is raised."""
        return self.read(table) if self.exists(table) else None

    def write(self, table: str, df: DataFrame, codec: str = "snappy") -> Commit:
        base = self.location(table)
        operation = "replace" if self.exists(table) else "create"
        snapshot_id = uuid.uuid4().int >> 65
        path = f"{base}/data/snap-{snapshot_id}"
        df.write.option("compression", codec).parquet(path)
        # counted from the written files' footers, so the plan of df does not run again
        rows = self.spark.read.parquet(path).count()
        commit = Commit(snapshot_id, datetime.now(timezone.utc).isoformat(), operation, rows, path)
        entry = literal_table(self.spark, [tuple(vars(commit).values())], LOG_SCHEMA)
        entry.write.mode("append").json(f"{base}/log")
        return commit

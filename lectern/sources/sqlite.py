"""Tables of SQLite files, read only, as a Spark data source; one partition for each file."""

from __future__ import annotations

import os
import sqlite3
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

KINDS = {"INTEGER": "bigint", "REAL": "double", "BLOB": "binary"}


def _open(path: str) -> sqlite3.Connection:
    """A missing file is an error and is never created."""
    if not os.path.isfile(path):
        raise FileNotFoundError(path)
    return sqlite3.connect(Path(path).resolve().as_uri() + "?mode=ro", uri=True)


def columns(path: str, table: str) -> list[tuple[str, str]]:
    db = _open(path)
    try:
        found = db.execute("SELECT name, type FROM pragma_table_info(?)", (table,)).fetchall()
    finally:
        db.close()
    if not found:
        raise ValueError(f"no table {table} in {path}")
    return [(n, KINDS.get((t or "").upper(), "string")) for n, t in found]


class SqliteSource(DataSource):
    """Options: path (files separated by ;), table."""

    @classmethod
    def name(cls) -> str:
        return "lectern_sqlite"

    def schema(self) -> str:
        return ", ".join(f"`{n}` {t}" for n, t in columns(self.options["path"].split(";")[0], self.options["table"]))

    def reader(self, schema) -> DataSourceReader:
        return SqliteReader(self.options["path"].split(";"), self.options["table"], schema)


class FilePartition(InputPartition):
    def __init__(self, path: str) -> None:
        super().__init__(0)
        self.path = path


class SqliteReader(DataSourceReader):
    def __init__(self, paths: list[str], table: str, schema) -> None:
        self.paths, self.table = paths, table
        self.fields = [(f.name, f.dataType.typeName()) for f in schema.fields]

    def partitions(self) -> list[InputPartition]:
        return [FilePartition(p) for p in self.paths]

    def read(self, partition: FilePartition) -> Iterator[tuple]:
        cast = {"long": int, "double": float, "string": str, "binary": bytes}
        db = _open(partition.path)
        try:
            names = ", ".join('"' + n.replace('"', '""') + '"' for n, _ in self.fields)
            table = self.table.replace('"', '""')
            for row in db.execute(f'SELECT {names} FROM "{table}"'):
                yield tuple(None if v is None else cast[t](v) for v, (_, t) in zip(row, self.fields))
        finally:
            db.close()


def read(spark: SparkSession, paths: list[str], table: str):
    spark.dataSource.register(SqliteSource)
    return spark.read.format("lectern_sqlite").option("path", ";".join(paths)).option("table", table).load()


def table_names(path: str) -> list[str]:
    db = _open(path)
    try:
        return [r[0] for r in db.execute("SELECT name FROM sqlite_master WHERE type = 'table' ORDER BY name")]
    finally:
        db.close()

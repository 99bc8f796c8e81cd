"""Execution journals (SQLite files) as a data source: read by the tasks, in ranges of ids, of which bounds leave some out."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Ids of a partition, and rows that a task fetches at once.
IDS, FETCH = 20_000, 1000
#: Kinds of SQLite's columns as Spark's.
KINDS = {"INTEGER": "long", "REAL": "double", "TEXT": "string", "BLOB": "binary"}

def opened(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


@dataclass
class Ids(InputPartition):
    """A file's rows with ids from first to last."""

    path: str
    first: int
    last: int


class JournalReader(DataSourceReader):
    """Partitions are ranges of ids within the bounds, so that other rows aren't read.

    The bounds are options and not pushed filters: a pushed filter stays with
    the relation, and other queries over the same rows would miss some.
    """

    def __init__(self, folder: str, table: str, columns: list[str], ids: int, least: int | None, most: int | None):
        self.folder, self.table, self.columns, self.ids, self.least, self.most = folder, table, columns, ids, least, most

    def partitions(self) -> list[InputPartition]:
        out = []
        for path in sorted(map(str, Path(self.folder).glob("*.db"))):
            with opened(path) as db:
                first, last = db.execute(f'SELECT min(id), max(id) FROM "{self.table}"').fetchone()  # noqa: S608
            if first is None:
                continue
            first = first if self.least is None else max(first, self.least)
            last = last if self.most is None else min(last, self.most)
            out += [Ids(path, k, min(k + self.ids - 1, last)) for k in range(first, last + 1, self.ids)]
        return out or [Ids("", 0, -1)]

    def read(self, partition: Ids) -> Iterator[tuple]:
        if not partition.path:
            return
        named = ", ".join(f'"{c}"' for c in self.columns)
        with opened(partition.path) as db:
            rows = db.execute(f'SELECT {named} FROM "{self.table}" WHERE id BETWEEN ? AND ? ORDER BY id', (partition.first, partition.last))  # noqa: S608
            while found := rows.fetchmany(FETCH):
                yield from found


class JournalSource(DataSource):
    """format("journal") with options path (a folder of .db files that driver and executors see), table, ids (of a partition), least and most (id)."""

    @classmethod
    def name(cls) -> str:
        return "journal"

    def _columns(self) -> list[tuple[str, str]]:
        for path in sorted(Path(self.options["path"]).glob("*.db")):
            with opened(str(path)) as db:
                return [(r[1], KINDS.get(r[2].upper(), "string")) for r in db.execute(f'PRAGMA table_info("{self.options["table"]}")')]
        raise ValueError("no journal is there")

    def schema(self) -> str:
        return ", ".join(f"`{name}` {kind}" for name, kind in self._columns())

    def reader(self, schema) -> JournalReader:
        bound = lambda name: int(self.options[name]) if name in self.options else None
        return JournalReader(self.options["path"], self.options["table"], schema.names, int(self.options.get("ids", IDS)), bound("least"), bound("most"))


def journals(spark: SparkSession, folder: str, table: str, ids: int = IDS, least: int | None = None, most: int | None = None) -> DataFrame:
    """The rows of a table of all journals of a folder, with ids from least to most if these are given; ids are integers, not null."""
    spark.dataSource.register(JournalSource)
    bounds = {name: str(x) for name, x in (("least", least), ("most", most)) if x is not None}
    return spark.read.format("journal").options(path=folder.removeprefix("file://"), table=table, ids=str(ids), **bounds).load()


def write_journals(rows: DataFrame, folder: str, table: str) -> None:
    """A journal for each partition of rows, which have an id; a file gets its name when it is whole."""
    kinds = {kind: sqlite for sqlite, kind in KINDS.items()}
    named = ", ".join(f'"{f.name}" {kinds.get(f.dataType.typeName(), "TEXT")}' + (" PRIMARY KEY" if f.name == "id" else "") for f in rows.schema.fields)
    marks, path = ", ".join("?" * len(rows.columns)), folder.removeprefix("file://")

    def write(batches):
        from pyspark import TaskContext

        context = TaskContext.get()
        Path(path).mkdir(parents=True, exist_ok=True)
        half = Path(path, f"part-{context.partitionId()}.{context.taskAttemptId()}.half")
        with sqlite3.connect(half) as db:
            db.execute(f'CREATE TABLE "{table}" ({named})')
            for batch in batches:
                db.executemany(f'INSERT INTO "{table}" VALUES ({marks})', zip(*(c.to_pylist() for c in batch.columns), strict=True))  # noqa: S608
        db.close()
        half.rename(Path(path, f"part-{context.partitionId()}.db"))
        yield from ()

    rows.mapInArrow(write, "done boolean").count()


def history(attempts: DataFrame) -> DataFrame:
    """attempts with usage as columns (prompt_tokens, completion_tokens, total_tokens) and whether it is unknown."""
    usage = F.from_json("usage", "prompt_tokens long, completion_tokens long, total_tokens long")
    return attempts.withColumn("usage", usage).select(*[c for c in attempts.columns if c != "usage"], "usage.*", F.col("usage.total_tokens").isNull().alias("unknown"))


def adapter_faults(files: DataFrame, registry: DataFrame, name: str = "name") -> DataFrame:
    """name, "check" of files that not exactly one adapter takes: "unsupported" or "ambiguous".

    registry: adapter, suffix (lower case, with its dot); endings of files count without regard to case.
    """
    suffix = F.lower(F.regexp_extract(F.col(name), r"(\.[^./]+)\z", 1))
    each = files.select(F.col(name), suffix.alias("suffix")).join(registry.select("suffix", "adapter").distinct(), "suffix", "left").groupBy(name).agg(F.count("adapter").alias("n"))
    return each.where("n <> 1").select(name, F.when(F.col("n") == 0, "unsupported").otherwise("ambiguous").alias("check"))

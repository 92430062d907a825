"""A commit log: new partitions of several tables become visible together, through one small file.

Every write goes to a folder of its own. A commit file then says, for each table and partition value, which folder holds
it. Readers pin one version and see it whole, whatever is written meanwhile; a run that fails before its commit has
changed nothing. The difference of two versions tells which partitions changed. A version lists partitions, not rows, so
the driver holds one entry per date or month of a table.

Layout below the log's root: `commits/<number>.json`, and `<table>/_write=<write>/<partition>=<value>/part-*`.
"""
from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.sources import files
from millrace.sources.tables import spread_for_write

#: The value of a table without partitions, and Spark's folder name for a NULL value.
WHOLE, NULL = "", "__HIVE_DEFAULT_PARTITION__"


class CommitConflict(RuntimeError):
    """Another run committed since this one began; nothing of this one is visible. Run it again."""


@dataclass(frozen=True)
class Version:
    """What one commit makes visible: table -> partition value -> folder, with notes of the writer."""
    number: int = 0
    tables: dict[str, dict[str, str]] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)
    digests: dict[str, dict[str, str]] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)

    def values(self, table: str) -> set[str]:
        return set(self.tables.get(table, {}))

    def changed(self, older: Version, table: str) -> set[str]:
        """Partition values whose content was written, added or removed since `older`."""
        now, then = self.tables.get(table, {}), older.tables.get(table, {})
        return {v for v in now.keys() | then.keys() if now.get(v) != then.get(v)}


def write_folder(df: DataFrame, path: str, partition: str | None) -> None:
    """The only place where data of a log is written."""
    writer = spread_for_write(df, [partition] if partition else []).write
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def new_write() -> str:
    """A folder name that Spark reads as a partition value, so that a table's folders have one root."""
    return f"_write=w{uuid.uuid4().hex}"


class Log:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # -- reading -------------------------------------------------------------------------------------
    def numbers(self) -> list[int]:
        names = [p.rsplit("/", 1)[1] for p in files.list_files(self.spark, f"{self.root}/commits/*.json")]
        return sorted(int(n.removesuffix(".json")) for n in names)

    def version(self, number: int) -> Version:
        """The version of a number; 0 is the empty one before the first commit."""
        if not number:
            return Version()
        text = files.read_small(self.spark, f"{self.root}/commits/{number:012d}.json")
        stored = json.loads(text)
        return Version(number, stored["tables"], stored["schemas"], stored["digests"], stored["notes"])

    def current(self) -> Version:
        return self.version(max(self.numbers(), default=0))

    def read(self, table: str, at: Version, values: Iterable[str] | None = None, schema: str | None = None) -> DataFrame:
        """A table as of a version, of some partition values or all; only their folders are listed and read. Without
        `schema` columns are those of the last write."""
        held = at.tables.get(table, {})
        schema = schema or StructType.fromJson(json.loads(at.schemas[table]))
        wanted = sorted(held if values is None else set(values) & set(held))
        if not wanted:
            return self.spark.createDataFrame([], schema)
        return (self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}")
                .parquet(*[f"{self.root}/{table}/{held[v]}" for v in wanted]).drop("_write"))

    # -- writing -------------------------------------------------------------------------------------
    def begin(self) -> Commit:
        return Commit(self, self.current())

    def vacuum(self, keep: int = 10, older_than_hours: float = 72) -> list[str]:
        """Removes versions but the last `keep`, and folders that none of those names. Young folders stay: they may belong
        to a run that has not committed yet."""
        numbers = self.numbers()
        kept = [self.version(n) for n in numbers[-keep:]] if keep else []
        named = {(t, folder.split("/")[0]) for v in kept for t, held in v.tables.items() for folder in held.values()}
        limit, removed = (time.time() - older_than_hours * 3600) * 1000, []
        for number in numbers[:-keep] if keep else numbers:
            files.remove_folder(self.spark, f"{self.root}/commits/{number:012d}.json")
        for path, modified in files.list_modified(self.spark, f"{self.root}/*/*"):
            table, write = path.rstrip("/").split("/")[-2:]
            if table != "commits" and (table, write) not in named and modified < limit:
                files.remove_folder(self.spark, path)
                removed.append(f"{table}/{write}")
        return removed


class Commit:
    """Writes of one run, invisible until `finish`. `base` is the version it began from."""

    def __init__(self, log: Log, base: Version):
        self.log, self.base = log, base
        self.tables = {t: dict(held) for t, held in base.tables.items()}
        self.schemas = dict(base.schemas)
        self.digests = {t: dict(held) for t, held in base.digests.items()}

    def replace(self, table: str, df: DataFrame, partition: str, touched: Iterable[str] | None = None,
                settle: bool = False) -> None:
        """Partitions present in `df` are replaced; those of `touched` without rows are gone; all others stay.

        With `settle` what was written is read once more for a digest of each partition's rows, and a partition whose
        rows are those it had keeps its folder: computed again is not changed.
        """
        write = new_write()
        path = f"{self.log.root}/{table}/{write}"
        write_folder(df, path, partition)
        kept = [f for f in df.schema.fields if f.name != partition]
        self.schemas[table] = StructType([*kept, df.schema[partition]]).json()
        held = self.tables.setdefault(table, {})
        for value in touched or ():
            held.pop(value, None)
        for folder in files.list_files(self.log.spark, f"{path}/{partition}=*"):
            name = folder.rstrip("/").rsplit("/", 1)[1]
            held[unquote(name.split("=", 1)[1])] = f"{write}/{name}"
        if settle:
            self._settle(table, partition, write)

    def _settle(self, table: str, partition: str, write: str) -> None:
        held, known = self.tables[table], self.digests.setdefault(table, {})
        written = {v for v, folder in held.items() if folder.startswith(f"{write}/")}
        rows = self.read(table, written)
        mixed = F.xxhash64(*[c for c in rows.columns if c != partition])
        digests = rows.groupBy(F.coalesce(F.col(partition).cast("string"), F.lit(NULL)).alias("value")).agg(
            F.concat_ws(":", F.count(F.lit(1)), F.sum(mixed.cast("decimal(38,0)")), F.bit_xor(F.xxhash64(mixed))).alias("digest"))
        before = self.base.tables.get(table, {})
        for value, digest in digests.collect():               # one row per partition
            if digest == known.get(value) and value in before:
                files.remove_folder(self.log.spark, f"{self.log.root}/{table}/{held[value]}")
                held[value] = before[value]
            known[value] = digest
        for value in known.keys() - held.keys():
            del known[value]

    def put(self, table: str, df: DataFrame, value: str = WHOLE) -> None:
        """A table without partitions, written whole; with `value`, one more part of such a table."""
        write = new_write()
        write_folder(df, f"{self.log.root}/{table}/{write}", None)
        self.schemas[table] = df.schema.json()
        self.tables.setdefault(table, {})[value] = write

    def remove(self, table: str, values: Iterable[str]) -> None:
        for value in values:
            self.tables.get(table, {}).pop(value, None)

    @property
    def so_far(self) -> Version:
        return Version(self.base.number, self.tables, self.schemas, self.digests)

    def read(self, table: str, values: Iterable[str] | None = None, schema: str | None = None) -> DataFrame:
        """A table as this run has left it so far."""
        return self.log.read(table, self.so_far, values, schema)

    def finish(self, **notes) -> Version:
        """Makes all writes visible at once, or raises CommitConflict."""
        number = self.base.number + 1
        text = json.dumps({"tables": self.tables, "schemas": self.schemas, "digests": self.digests, "notes": notes}, sort_keys=True)
        if not files.write_new(self.log.spark, f"{self.log.root}/commits/{number:012d}.json", text):
            raise CommitConflict(f"version {number} of {self.log.root} was committed by another run")
        return Version(number, self.tables, self.schemas, self.digests, notes)

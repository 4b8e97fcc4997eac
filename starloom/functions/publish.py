"""Writing first, checking, publishing last.

* ``write_checked`` writes a table and counts its rows and violations in the same
  pass (``DataFrame.observe``); a table with violations raises ``AuditError``.
* ``Parts`` holds tables that are replaced part by part (a key bucket, a month). New
  content is written once, to a folder of its own attempt. One small table, written
  last, says for all tables which attempt a part's content is in; readers resolve
  through it. What was staged before a failure is in no reader's way.
* ``builds`` / ``note_build``: the same for whole builds, one row a build.

The small tables are parquet of one file that is appended, so a reader sees the rows
of the newest number or, if their write failed, those of the one before. There is
one writer at a time; nothing here locks or merges.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import storage
from starloom.functions.storage import CODEC, shuffles_dropped

c = F.col


class AuditError(ValueError):
    """A table that was staged but not published, with what was counted."""

    def __init__(self, name: str, counts: dict[str, int]):
        super().__init__(f"{name} is not published: {counts}")
        self.name, self.counts = name, counts


# ---------------------------------------------------------------- checks
def known(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [c(k).isNotNull() for k in keys])  # a NULL key matches nothing


def repeated(keys: list[str], within: tuple[str, ...] = ()) -> Column:
    """A row whose key has been seen. ``within``: columns that follow from the key
    and by which the rows are laid out already, so no shuffle is needed."""
    w = Window.partitionBy(*within, *keys).orderBy(*keys)
    return (F.row_number().over(w) > 1) & known(keys)


def second_current(key: str = "customer_id", within: tuple[str, ...] = ()) -> Column:
    """A current version of a key that has one already."""
    is_current = F.coalesce(c("current_flag"), F.lit(False)).cast("int")
    w = Window.partitionBy(*within, key).orderBy("effective_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (is_current == 1) & (F.sum(is_current).over(w) > 1) & known([key])


def write_checked(df: DataFrame, path: str, checks: dict[str, Column], tops: tuple[str, ...] = (), partition_by: tuple[str, ...] = (), name: str | None = None, drop: tuple[str, ...] = (), mode: str = "errorifexists") -> dict[str, int | None]:
    """Write ``df`` without the columns ``drop`` to a new folder (``mode`` append: to one
    that has rows); returns ``rows``, the count of each check's
    violations (all 0) and the largest value of each of ``tops``. The counts are
    those of the writing tasks that were committed."""
    flags = {f"_bad_{k}": v for k, v in checks.items()}
    counts = [F.coalesce(F.sum(c(f"_bad_{k}").cast("long")), F.lit(0)).alias(k) for k in checks]
    seen = Observation()
    watched = df.withColumns(flags) if flags else df
    watched = watched.observe(seen, F.count(F.lit(1)).alias("rows"), *counts, *[F.max(t).alias(t) for t in tops]).drop(*flags, *drop)
    writer = watched.write.mode(mode).option("compression", CODEC)
    with shuffles_dropped(df.sparkSession):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    got = dict(seen.get)
    bad = {k: got[k] for k in checks if got[k]}
    if bad:
        raise AuditError(name or path.rsplit("/", 1)[-1], {"rows": got["rows"], **bad})
    return got


# ---------------------------------------------------------------- folders
def _folder(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, system = _folder(spark, path)
    return system.exists(target)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    target, system = _folder(spark, path)
    if not system.exists(target):
        return []
    return [s.getPath().getName() for s in system.listStatus(target) if s.isDirectory()]


def drop_folder(spark: SparkSession, path: str) -> None:
    target, system = _folder(spark, path)
    system.delete(target, True)


def written(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to ``path`` to the end (once at least)."""
    return exists(spark, f"{path}/_SUCCESS")


def _newest(spark: SparkSession, path: str, number: str = "number") -> list:
    """Rows of the largest number in a small table, none if there is no table."""
    if not written(spark, path):
        return []
    rows = spark.read.parquet(path)
    return rows.filter(c(number) == rows.agg(F.max(number)).first()[0]).collect()


def _note(spark: SparkSession, path: str, rows: list[tuple], schema: str) -> None:
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


# ----------------------------------------------------------------- builds
BUILDS = "number long, day date, build string"


def builds(spark: SparkSession, root: str) -> list:
    """(number, day, build) of the published builds, in order; a row a build."""
    path = f"{root}/_builds"
    return spark.read.parquet(path).orderBy("number").collect() if written(spark, path) else []


def note_build(spark: SparkSession, root: str, day, build: str) -> None:
    """Publish a build: readers see it from now on."""
    earlier = builds(spark, root)
    _note(spark, f"{root}/_builds", [((earlier[-1].number if earlier else 0) + 1, day, build)], BUILDS)


# ------------------------------------------------------------------ parts
PART, ATTEMPT, SLICE = "part", "attempt", "_slice"
NO_ROWS = ""  # the attempt of a part without rows, which has no folder
OVER = "+"  # between the attempts that a part's content is in: rows of later ones stand for those of their keys before
MOST_LAYERS = 5
FEW_PARTS = 32
MOST_FILES = 8  # files for each slice of a part, before its rows are laid out anew


def _layers(attempts: str) -> list[str]:
    return attempts.split(OVER) if attempts != NO_ROWS else []


@dataclass(frozen=True)
class Table:
    """A table by parts: its columns, its key, the part of a row (an expression that
    gives an integer), and in how many slices of the key a part is written."""

    schema: T.StructType
    keys: list[str]
    part: Column
    slices: int = 4
    checks: dict = field(default_factory=dict)  # name -> function of the layout's columns
    tops: tuple[str, ...] = ()


class Parts:
    """Tables below ``root``; ``read`` also sees what this object has staged and not
    yet published."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.tables: dict[str, Table] = {}
        self.at: dict[str, dict[int, str]] = {}
        rows = _newest(spark, self._pointer)
        self.number = rows[0].number if rows else 0
        for r in rows:
            self.at.setdefault(r.name, {})[r.part] = r.attempt
        self.staged: dict[str, dict[int, str]] = {}
        self.folders: list[str] = []
        self.replaced: set[tuple[str, str]] = set()  # (table, attempt) that the last publication left
        self.laid_over: dict[tuple[str, str], int] = {}  # rows of the attempts that this object has laid over others

    @property
    def _pointer(self) -> str:
        return f"{self.root}/_published"

    def read(self, name: str, parts: list[int] | None = None) -> DataFrame:
        """Rows of the given parts (default: all). Only their folders are listed."""
        table = self.tables[name]
        at = {**self.at.get(name, {}), **self.staged.get(name, {})}
        by: dict[str, list[int]] = {}
        over: set[str] = set()
        for p in at if parts is None else [p for p in parts if p in at]:
            for k, a in enumerate(_layers(at[p])):
                by.setdefault(a, []).append(p)
                over |= {a} if k else set()
        if not by:
            return self.spark.createDataFrame([], table.schema)
        if not over:
            return self._rows(name, by)
        groups: dict[tuple[str, ...], dict[str, list[int]]] = {}  # attempts by what lies over them
        for a, ps in by.items():
            groups.setdefault(tuple(sorted(x for x in over if x > a)), {})[a] = ps
        found = []
        for later, own in groups.items():
            rows = self._rows(name, own)
            if later:
                rows = rows.join(F.broadcast(self._rows(name, {a: by[a] for a in later}).select(*table.keys)), table.keys, "left_anti")
            found.append(rows.select(*table.schema.names))
        return reduce(DataFrame.unionByName, found)

    def _rows(self, name: str, by: dict[str, list[int]]) -> DataFrame:
        """What was written by these attempts for these parts."""
        table, base = self.tables[name], f"{self.root}/{name}"
        paths = []
        for a, ps in by.items():  # a few parts' folders, or the attempt's and a filter on its folders' names
            paths += [f"{base}/{ATTEMPT}={a}/{PART}={p}" for p in ps] if len(ps) <= FEW_PARTS else [f"{base}/{ATTEMPT}={a}"]
        schema = T.StructType([*table.schema.fields, T.StructField(ATTEMPT, T.StringType()), T.StructField(PART, T.IntegerType())])
        rows = self.spark.read.schema(schema).option("basePath", base).parquet(*paths)
        mine = reduce(or_, [(c(ATTEMPT) == a) & c(PART).isin(ps) for a, ps in by.items()])
        return rows.filter(mine).drop(ATTEMPT, PART)

    def _scattered(self, name: str, parts: list[int] | None) -> bool:
        """Whether the content of the parts lies in many files."""
        at = {**self.at.get(name, {}), **self.staged.get(name, {})}
        n = len(at if parts is None else parts)
        return len(self.read(name, parts).inputFiles()) > MOST_FILES * self.tables[name].slices * n

    def stage(self, name: str, df: DataFrame, parts: list[int] | None = None, kept: DataFrame | list[DataFrame] | None = None) -> dict[str, int | None]:
        """Write the new content of ``parts`` (default: all that the rows are in)
        once, laid out by part and slice of the key, counted while it is written.
        Raises ``AuditError`` if a check fails.

        ``kept``: rows of these parts, as ``read`` gives them, that stay as they are
        beside the rows of ``df``. They are written from where they are read, without a
        shuffle, until a part has come to lie in many files; the checks then read the
        written columns that they need. A list of such rows is written one after the
        other."""
        table = self.tables[name]
        kept = [] if kept is None else list(kept) if isinstance(kept, list) else [kept]
        if kept and self._scattered(name, parts):
            df, kept = reduce(DataFrame.unionByName, [k.select(*table.schema.names) for k in [*kept, df]]), []
        attempt = f"{self.number + 1:08d}-{uuid.uuid4().hex[:8]}"
        path = f"{self.root}/{name}/{ATTEMPT}={attempt}"
        self.folders.append(path)
        rows = df.withColumns({PART: table.part.cast("int"), SLICE: F.pmod(F.xxhash64(*table.keys), F.lit(table.slices))})
        rows = rows.select(*table.schema.names, PART, SLICE).repartition(PART, SLICE)
        checks = {} if kept else {k: make((PART, SLICE)) for k, make in table.checks.items()}
        if parts is not None:  # such a row would be in no reader's sight
            checks["in_another_part"] = ~c(PART).isin(parts)
        for k, more in enumerate(kept):
            more = more.withColumns({PART: table.part.cast("int"), SLICE: F.lit(0).cast("long")}).select(*rows.columns)
            kept[k] = more if k else more.unionByName(rows)
        got: dict[str, int | None] = {}
        for k, content in enumerate(kept or [rows]):
            more = write_checked(content, path, checks, table.tops, (PART,), name, drop=(SLICE,), mode="append" if k else "errorifexists")
            for x, v in more.items():
                was = got.get(x)
                got[x] = v if was is None else was if v is None else max(was, v) if x in table.tops else was + v
        if kept:
            got |= self._check(name, path, got["rows"])
        has_rows = {int(f.removeprefix(f"{PART}=")) for f in subfolders(self.spark, path)}
        content = {p: attempt if p in has_rows else NO_ROWS for p in (has_rows if parts is None else parts)}
        self.staged.setdefault(name, {}).update(content)
        return got

    def may_lie_over(self, name: str, rows: int, parts: list[int]) -> bool:
        """Whether ``stage_over`` may take so many rows: what lies over other content must
        be few enough to be broadcast to every reader, in few attempts, and counted."""
        at = {**self.at.get(name, {}), **self.staged.get(name, {})}
        over = {a for p in at for a in _layers(at[p])[1:]}
        if any(len(_layers(at[p])) >= MOST_LAYERS for p in parts if p in at) or any((name, a) not in self.laid_over for a in over):
            return False
        return rows + sum(self.laid_over[name, a] for a in over) <= storage.BROADCAST_ROWS

    def stage_over(self, name: str, df: DataFrame, parts: list[int]) -> dict[str, int | None]:
        """Lay rows of ``parts`` over what is there: each stands for the row of its key,
        if there is one. Only for tables whose part follows from the key, and rows
        whose key has no NULL."""
        before = {**self.at.get(name, {}), **self.staged.get(name, {})}
        got = self.stage(name, df, parts)
        staged = self.staged[name]
        for p in parts:
            own, was = staged[p], before.get(p, NO_ROWS)
            staged[p] = OVER.join(x for x in (was, own) if x != NO_ROWS)
            if own != NO_ROWS:
                self.laid_over[name, own] = got["rows"]
        return got

    def _check(self, name: str, path: str, n: int) -> dict[str, int]:
        """The checks of a table over what was written to ``path``."""
        table = self.tables[name]
        if not (n and table.checks):
            return dict.fromkeys(table.checks, 0)
        rows = self.spark.read.schema(T.StructType([*table.schema.fields, T.StructField(PART, T.IntegerType())])).parquet(path)
        flags = rows.select(*[make((PART,)).cast("long").alias(k) for k, make in table.checks.items()])
        got = flags.agg(*[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in table.checks]).first().asDict()
        if bad := {k: v for k, v in got.items() if v}:
            raise AuditError(name, {"rows": n, **bad})
        return got

    def publish(self) -> None:
        """Make everything staged the content that readers see, all tables at once.
        Content that this replaces stays for those who are reading it; what had been
        replaced before is deleted."""
        earlier = self._used()
        for name, parts in self.staged.items():
            self.at.setdefault(name, {}).update(parts)
        self.staged, self.folders = {}, []
        rows = [(self.number + 1, name, p, a) for name, parts in self.at.items() for p, a in parts.items()]
        _note(self.spark, self._pointer, rows, "number long, name string, part int, attempt string")
        self.number += 1
        gone, self.replaced = self.replaced, earlier - self._used()
        for name, a in gone:
            drop_folder(self.spark, f"{self.root}/{name}/{ATTEMPT}={a}")

    def _used(self) -> set[tuple[str, str]]:
        return {(name, a) for name, parts in self.at.items() for layers in parts.values() for a in _layers(layers)}

    def discard(self) -> None:
        """Forget, and delete, what was staged since the last publication."""
        for path in self.folders:
            drop_folder(self.spark, path)
        self.staged, self.folders = {}, []

    def prune(self) -> int:
        """Delete the folders that no part is in any more; returns how many."""
        n = 0
        for name in self.tables:
            used = {a for at in (self.at, self.staged) for layers in at.get(name, {}).values() for a in _layers(layers)}
            for folder in subfolders(self.spark, f"{self.root}/{name}"):
                if folder.startswith(f"{ATTEMPT}=") and folder.removeprefix(f"{ATTEMPT}=") not in used:
                    drop_folder(self.spark, f"{self.root}/{name}/{folder}")
                    n += 1
        return n


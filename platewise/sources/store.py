"""A folder of tables whose content changes in one step.

New rows always go to a new folder. What belongs to each table is listed in a manifest, and a version exists from the moment in which its manifest
is there: readers see the old tables or the new ones, all of them of one version, also if a load dies half-way. Two loads at a time cannot
both add the same version.

Layout: ``<table>/load=<id>/..`` holds rows, ``_versions/<number>.json`` the manifests. A table is plain, in buckets of a key, or in parts: one folder for each
value of a column, which has few values such as days. A part whose rows are those of the current version keeps its folder; rows are compared by
their number and two sums of hashes, which do not depend on their order.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platewise.operators.lookup import HotKeys
from platewise.sources.buckets import Bucketed, deal, forget_buckets, is_hot, scan_buckets, write_buckets

_VERSIONS = "_versions"
_NULL_PART = "__HIVE_DEFAULT_PARTITION__"
_WHOLE, _HOT = "", "hot"


@dataclass(frozen=True)
class Part:
    """A folder of rows, relative to the table's."""

    path: str
    rows: int
    digest: str = ""


@dataclass(frozen=True)
class Entry:
    """What a version says about one table."""

    ddl: str
    parts: Mapping[str, Part]
    partition_by: str | None = None
    key: str | None = None
    buckets: int = 0
    hot: tuple[int, ...] = ()

    @property
    def rows(self) -> int:
        return sum(part.rows for part in self.parts.values())

    @staticmethod
    def of(fields: dict) -> Entry:
        parts = {value: Part(**part) for value, part in fields.pop("parts").items()}
        return Entry(parts=parts, hot=tuple(fields.pop("hot")), **fields)


class Store:
    """Tables under ``folder``, which every executor can reach."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    # ------------------------------------------------------------ versions

    def version(self) -> int:
        """Number of the current version, 0 before the first one."""
        return max(self._numbers(), default=0)

    def entries(self, version: int | None = None) -> dict[str, Entry]:
        number = self.version() if version is None else version
        if not number:
            return {}
        with_tables = json.loads(self._text(self._manifest(number)))
        return {name: Entry.of(fields) for name, fields in with_tables.items()}

    def commit(self, written: Mapping[str, Entry], onto: int | None = None) -> int:
        """Add a version in which the written tables are new and all others as they were; its number.

        ``onto`` is the version that the load has begun with: if another load has added one meanwhile, this one fails and changes nothing.
        """
        base = self.version() if onto is None else onto
        tables = {name: asdict(entry) for name, entry in (self.entries(base) | dict(written)).items()}
        self._publish(self._manifest(base + 1), json.dumps(tables))
        return base + 1

    def clean(self, keep: int = 1) -> None:
        """Delete what the last ``keep`` versions don't need. No load may be running, and nobody reading an older version."""
        numbers = sorted(self._numbers())
        kept = numbers[-keep:] if keep else []
        needed: dict[str, set[str]] = {}
        for number in kept:
            for name, entry in self.entries(number).items():
                needed.setdefault(name, set()).update(part.path.split("/")[0] for part in entry.parts.values())
        for number in numbers:
            if number not in kept:
                self._delete(self._manifest(number))
        for name in self._children(self.folder):
            for load in self._children(f"{self.folder}/{name}") if name != _VERSIONS else ():
                if load.startswith("load=") and load not in needed.get(name, ()):
                    self._delete(f"{self.folder}/{name}/{load}")

    # ------------------------------------------------------------ reading

    def read(self, name: str, version: int | None = None) -> DataFrame:
        return self.scan(name, self.entries(version)[name])

    def scan(self, name: str, entry: Entry) -> DataFrame:
        """The rows of an entry, also of one that belongs to no version yet."""
        if entry.key:
            return self.bucketed(name, entry).all()
        base, columns = f"{self.folder}/{name}", T.StructType.fromDDL(entry.ddl)
        paths = [f"{base}/{part.path}" for part in entry.parts.values()]
        if not paths:
            return self.spark.createDataFrame([], columns)
        rows = self.spark.read.schema(columns).option("basePath", base).parquet(*paths)
        return rows.select(*[F.col(f"`{c}`") for c in columns.names])

    def bucketed(self, name: str, entry: Entry | None = None) -> Bucketed:
        """A bucketed table, to be joined in place."""
        entry = entry or self.entries()[name]
        base = f"{self.folder}/{name}"
        ordinary = scan_buckets(self.spark, f"{base}/{entry.parts[_WHOLE].path}", entry.ddl, entry.key, entry.buckets)
        hot = None
        if _HOT in entry.parts:
            hot = self.spark.read.schema(entry.ddl).parquet(f"{base}/{entry.parts[_HOT].path}")
        return Bucketed(ordinary, entry.key, entry.buckets, hot, entry.hot)

    # ------------------------------------------------------------ writing

    def write(self, name: str, df: DataFrame) -> Entry:
        """Rows of a plain table. Like all writes, it changes nothing before it is committed."""
        load = self._new_load()
        rows = _counted(df, lambda frame: frame.write.parquet(f"{self.folder}/{name}/{load}"))
        return Entry(_ddl(df), {_WHOLE: Part(load, rows)})

    def append(self, name: str, df: DataFrame) -> Entry:
        """The current rows of a plain table, and these."""
        old, new = self.entries().get(name), self.write(name, df)
        if old is None:
            return new
        return Entry(old.ddl, {**old.parts, new.parts[_WHOLE].path: new.parts[_WHOLE]})

    def write_buckets(self, name: str, df: DataFrame, key: str, buckets: int, hot: HotKeys | None = None) -> Entry:
        """Rows in buckets of ``key``; the rows of hot keys beside them, in a folder of their own."""
        ordinary = df.where(~is_hot(key, hot)) if hot else df
        return self.write_dealt(name, deal(ordinary, key, buckets), key, buckets, df.where(is_hot(key, hot)) if hot else None, tuple(hot or ()))

    def write_dealt(
        self, name: str, ordinary: DataFrame, key: str, buckets: int, hot_rows: DataFrame | None = None, hot: tuple[int, ...] = ()
    ) -> Entry:
        """The same for rows that are dealt out by ``key`` already."""
        load = self._new_load()
        path = f"{self.folder}/{name}/{load}"
        parts = {_WHOLE: Part(load, _counted(ordinary, lambda frame: write_buckets(frame, path, key, buckets)))}
        if hot_rows is not None:
            beside = self._new_load()
            rows = _counted(hot_rows, lambda frame: frame.write.parquet(f"{self.folder}/{name}/{beside}"))
            parts[_HOT] = Part(beside, rows)
        return Entry(_ddl(ordinary), parts, key=key, buckets=buckets, hot=tuple(hot))

    def write_parts(self, name: str, df: DataFrame, by: str) -> Entry:
        """Rows in one folder for each value of ``by``; parts that equal those of the current version are not written again.

        With a current version the rows are worked out once for their digests, and those of changed parts a second time to be
        written. Parts that have no rows any more go.
        """
        old = self.entries().get(name)
        ddl, kept = _ddl(df), {}
        if old is not None and (old.ddl, old.partition_by) == (ddl, by):
            now = {value: digest for value, _, digest in _digests(df, by)}
            kept = {value: old.parts[value] for value, digest in now.items() if value in old.parts and old.parts[value].digest == digest}
            changed = [value for value in now if value not in kept]
            if not changed:
                return Entry(ddl, kept, partition_by=by)
            df = df.where(F.coalesce(F.col(by).cast("string"), F.lit(_NULL_PART)).isin(*changed)) if kept else df
        load = self._new_load()
        base = f"{self.folder}/{name}"
        df.hint("rebalance", by).write.partitionBy(by).parquet(f"{base}/{load}")
        folders = [f for f in self._children(f"{base}/{load}") if f.startswith(f"{by}=")]
        if not folders:
            return Entry(ddl, kept, partition_by=by)
        back = self.spark.read.schema(df.schema).parquet(f"{base}/{load}").select(*df.columns)
        found = {value: (rows, digest) for value, rows, digest in _digests(back, by)}
        new = {value: Part(f"{load}/{by}={value}", *found[value]) for value in found}
        return Entry(ddl, dict(sorted((kept | new).items())), partition_by=by)

    # ------------------------------------------------------------ files

    def _new_load(self) -> str:
        return f"load={uuid.uuid4().hex[:16]}"

    def _manifest(self, number: int) -> str:
        return f"{self.folder}/{_VERSIONS}/{number:09d}.json"

    def _numbers(self) -> list[int]:
        return [int(f.removesuffix(".json")) for f in self._children(f"{self.folder}/{_VERSIONS}") if f.endswith(".json")]

    def _files(self, path: str):
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), place

    def _children(self, path: str) -> list[str]:
        files, place = self._files(path)
        return sorted(status.getPath().getName() for status in files.listStatus(place)) if files.exists(place) else []

    def _text(self, path: str) -> str:
        files, place = self._files(path)
        stream = files.open(place)
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _publish(self, path: str, text: str) -> None:
        """Put a whole file in its place; one that is there stays."""
        files, place = self._files(path)
        draft = self._files(f"{self.folder}/{_VERSIONS}/.{uuid.uuid4().hex}")[1]
        stream = files.create(draft, False)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        if files.exists(place) or not files.rename(draft, place):
            files.delete(draft, False)
            raise RuntimeError(f"another load has changed {self.folder} meanwhile")

    def _delete(self, path: str) -> None:
        forget_buckets(self.spark, path)
        files, place = self._files(path)
        files.delete(place, True)


def _ddl(df: DataFrame) -> str:
    """Columns and types; every column may be null, as in files that are read back."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _counted(df: DataFrame, write) -> int:
    """Rows that a write has written, counted in its last stage: a repeated task counts once."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return seen.get["n"]


def _digests(df: DataFrame, by: str) -> list[tuple[str, int, str]]:
    """Rows and an order-free digest of every value of ``by``, one small row each."""
    sums = [F.sum(F.xxhash64(*salt, *df.columns).cast("decimal(38,0)")) for salt in ([], [F.lit("second")])]
    value = F.coalesce(F.col(by).cast("string"), F.lit(_NULL_PART)).alias("value")
    rows = df.groupBy(value).agg(F.count(F.lit(1)).alias("n"), *[s.alias(f"s{i}") for i, s in enumerate(sums)])
    return [(r["value"], r["n"], f"{r['n']}:{r['s0']}:{r['s1']}") for r in rows.collect()]

"""Scan of a database table through a Python database module, in parallel by ranges of a key.

Without being told bounds, the scan asks the database where the key's values lie and cuts it into ranges of equally many rows, so a skewed or gappy key is read
evenly. Every range is a query of its own on an executor's own connection; filters that the module's dialect can take are part of it. Rows come in Arrow batches.
The module (such as ``sqlite3``) must be importable on the executors, and the database reachable from them.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Iterator, Mapping
from contextlib import closing
from datetime import date, datetime
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.types import StructType

PARTITIONS = 64
FETCH = 10_000  # rows of a batch

_PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
_COMPARISONS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def read_database(
    spark: SparkSession, module: str, connection: Mapping[str, object], table: str, schema: str | StructType, key: str, partitions: int = PARTITIONS
) -> DataFrame:
    """Scan of ``table``. ``connection`` holds the arguments of the module's ``connect``; ``key`` is a column by whose values the table is cut."""
    spark.conf.set(_PUSHDOWN, "true")
    spark.dataSource.register(DatabaseTable)
    options = {"module": module, "connection": json.dumps(dict(connection)), "table": table, "key": key, "partitions": str(partitions)}
    return spark.read.format(DatabaseTable.name()).schema(schema).options(**options).load()


class DatabaseTable(DataSource):
    @classmethod
    def name(cls) -> str:
        return "platewise_database"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options, schema)


class _Range(InputPartition):
    """Rows with low <= key < high; the first range also has the rows without a key."""

    def __init__(self, low, high) -> None:
        super().__init__((low, high))


class _Reader(DataSourceReader):
    def __init__(self, options: Mapping[str, str], schema: StructType) -> None:
        self.module, self.table, self.key = options["module"], options["table"], options["key"]
        self.connection, self.wanted = json.loads(options["connection"]), int(options["partitions"])
        self.schema = schema
        self.conditions: list[tuple[str, list]] = []

    def _connect(self):
        return closing(importlib.import_module(self.module).connect(**self.connection))

    def _mark(self) -> str:
        return {"qmark": "?", "format": "%s", "pyformat": "%s"}[importlib.import_module(self.module).paramstyle]

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Takes what it can say in SQL, and returns the rest."""
        mark = self._mark()
        for each in filters:
            column = _quoted(each.attribute[0]) if hasattr(each, "attribute") and len(each.attribute) == 1 else None
            values = list(each.value) if isinstance(each, In) else [getattr(each, "value", 0)]
            if column is None or not all(isinstance(v, (int, float, str)) and not isinstance(v, bool) for v in values):
                yield each
            elif type(each) in _COMPARISONS:
                self.conditions.append((f"{column} {_COMPARISONS[type(each)]} {mark}", values))
            elif isinstance(each, In) and values:
                self.conditions.append((f"{column} IN ({', '.join([mark] * len(values))})", values))
            elif isinstance(each, (IsNull, IsNotNull)):
                self.conditions.append((f"{column} IS {'NOT ' * isinstance(each, IsNotNull)}NULL", []))
            else:
                yield each

    def partitions(self) -> list[InputPartition]:
        """Ranges of about equally many rows; one row for each comes back."""
        key = _quoted(self.key)
        tiles = f"SELECT {key} AS k, ntile({self.wanted}) OVER (ORDER BY {key}) AS tile FROM {self.table} WHERE {key} IS NOT NULL"
        with self._connect() as open_, closing(open_.cursor()) as cursor:
            cursor.execute(f"SELECT min(k) FROM ({tiles}) t GROUP BY tile ORDER BY 1")
            starts = [row[0] for row in cursor.fetchall()]
        cuts = sorted(set(starts[1:]) - set(starts[:1]))  # a value that fills several ranges begins one
        return [_Range(low, high) for low, high in zip([None, *cuts], [*cuts, None])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        low, high = partition.value
        key, mark = _quoted(self.key), self._mark()
        conditions = list(self.conditions)
        if low is not None:
            conditions.append((f"{key} >= {mark}", [low]))
        if high is not None:
            below = f"{key} < {mark}"
            conditions.append((below if low is not None else f"({below} OR {key} IS NULL)", [high]))
        where = f" WHERE {' AND '.join(text for text, _ in conditions)}" if conditions else ""
        columns = ", ".join(_quoted(name) for name in self.schema.names)
        arrow = _arrow_schema(self.schema)
        with self._connect() as open_, closing(open_.cursor()) as cursor:
            cursor.execute(f"SELECT {columns} FROM {self.table}{where}", [v for _, values in conditions for v in values])
            while rows := cursor.fetchmany(FETCH):
                yield pa.RecordBatch.from_arrays([_column(values, field.type) for values, field in zip(zip(*rows), arrow)], schema=arrow)


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _arrow_schema(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _column(values: tuple, kind: pa.DataType) -> pa.Array:
    """A column in its declared type; text stands for dates, times and amounts where the database has no such types."""
    if pa.types.is_decimal(kind):
        step = Decimal(1).scaleb(-kind.scale)
        values = [None if v is None else Decimal(str(v)).quantize(step) for v in values]
    elif pa.types.is_timestamp(kind):
        values = [datetime.fromisoformat(v) if isinstance(v, str) else v for v in values]
    elif pa.types.is_date(kind):
        values = [date.fromisoformat(v) if isinstance(v, str) else v for v in values]
    elif pa.types.is_boolean(kind):
        values = [None if v is None else bool(v) for v in values]
    return pa.array(values, kind)

"""Reading SQLite tables through a Python data source: spark.read.format("sqlite_table").option("path", ...)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from .staging import staged

KINDS = {"INTEGER": "long", "INT": "long", "BIGINT": "long", "REAL": "double", "TEXT": "string", "TIMESTAMP": "string", "BLOB": "binary"}


#: Comparisons that SQLite makes as Spark does, on columns that hold whole numbers or texts only.
OPERATORS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
EXACT = {"bigint": int, "string": str}


class Range(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class SqliteReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.table, self.parts = options["path"], options["table"], int(options.get("partitions", 4))
        self.names = [f.name for f in schema.fields]
        self.kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
        self.conditions: list[str] = []
        self.values: list = []

    def _connect(self):
        import sqlite3

        return sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)

    def _condition(self, f: Filter) -> tuple[str, list] | None:
        """The filter as a condition with its values, or None where SQLite might see it otherwise."""
        column = ".".join(getattr(f, "attribute", ()))
        if column not in self.kinds:
            return None
        name, kind = '"%s"' % column.replace('"', '""'), EXACT.get(self.kinds[column])
        if isinstance(f, (IsNull, IsNotNull)):
            return f"{name} IS {'NOT ' if isinstance(f, IsNotNull) else ''}NULL", []
        if kind is None:
            return None
        if isinstance(f, In) and all(type(v) is kind for v in f.value):
            return f"{name} IN ({', '.join('?' * len(f.value))})", list(f.value)
        if type(f) in OPERATORS and type(f.value) is kind:
            return f"{name} {OPERATORS[type(f)]} ?", [f.value]
        return None

    def statement(self, partition: Range) -> tuple[str, list]:
        columns = ", ".join(f'"{n}"' for n in self.names)
        where = " AND ".join(["rowid >= ? AND rowid < ?", *self.conditions])
        return f'SELECT {columns} FROM "{self.table}" WHERE {where}', [partition.low, partition.high, *self.values]

    def partitions(self):
        with self._connect() as c:
            low, high = c.execute(f'SELECT min(rowid), max(rowid) FROM "{self.table}"').fetchone()
        if low is None:
            return []
        step = max(1, -(-(high - low + 1) // self.parts))
        return [Range(a, min(a + step, high + 1)) for a in range(low, high + 1, step)]

    def read(self, partition):
        with self._connect() as c:
            yield from c.execute(*self.statement(partition))


class FilteringReader(SqliteReader):
    """The reader that takes filters; Spark refuses it where handing on filters is off."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802 (name of the interface)
        """Takes over the filters that go into the statement; the others are left to Spark."""
        for f in filters:
            told = self._condition(f)
            if told is None:
                yield f
            else:
                self.conditions.append(told[0])
                self.values += told[1]


class SqliteTable(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite_table"

    def schema(self) -> str:
        import sqlite3

        with sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True) as c:
            info = c.execute(f'PRAGMA table_info("{self.options["table"]}")').fetchall()
        if not info:
            raise ValueError(f"no such table: {self.options['table']}")
        return ", ".join(f"`{n}` {KINDS.get((kind or 'TEXT').upper(), 'string')}" for _, n, kind, *_ in info)

    def reader(self, schema: StructType) -> SqliteReader:
        return (FilteringReader if self.options.get("filters") == "true" else SqliteReader)(self.options, schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SqliteTable)


def rows_where(spark: SparkSession, path: str, table: str, condition: str) -> DataFrame:
    """The rows of a table that meet a condition, of which SQLite checks what it can; written down at once.

    Spark 4.1 keeps the filters that one query handed to a source in Python for later queries of the same DataFrame that hand it none, which then
    lose rows. So filters are handed on here only, for one query of one DataFrame."""
    register(spark)
    name = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        return staged(filtered(spark, path, table).where(condition))
    finally:
        spark.conf.set(name, before)


def filtered(spark: SparkSession, path: str, table: str) -> DataFrame:
    return spark.read.format("sqlite_table").options(path=path, table=table, filters="true").load()

"""Connectors as Spark data sources, by name: a year is a partition of its cases.

Only sources that need no network are here; a connector to a real collection subclasses Connector.
Conditions on the year are pushed into the source where the session allows it
(`spark.sql.python.filterPushdown.enabled`): years outside of them are not planned, so not asked for.
"""

from __future__ import annotations

import datetime
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyarrow import dataset
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual,
)

LISTED = "id string, title string, year int"
DETAILED = "id string, title string, citation string, court string, date string, year int, judges array<string>, text string, headnote string"


class Connector:
    """What a collection offers. Unsupported enumerations raise; courts and journals default to none.

    As a context manager it authenticates on entry and closes on exit.
    """

    name = ""

    def __init__(self, **options: str):
        """options: those of the data source, for connectors that need some."""
        self.options = options

    def __enter__(self) -> Connector:
        if not self.authenticate():
            raise PermissionError(f"{self.name} refused to authenticate")
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        """Gives back what authenticating took; nothing by default."""

    def authenticate(self) -> bool:
        raise NotImplementedError

    def search(self, query: str, **options) -> Iterator[tuple]:
        raise NotImplementedError

    def enumerate_by_citation(self, prefix: str) -> Iterator[tuple]:
        raise NotImplementedError(f"{self.name} cannot list citations")

    def enumerate_by_year(self, year: int) -> Iterator[tuple]:
        raise NotImplementedError(f"{self.name} cannot list a year")

    def batches_by_year(self, year: int) -> Iterator[pa.RecordBatch]:
        """What enumerate_by_year gives, as Arrow batches; for connectors whose collection has columns, overridden."""
        rows = self.enumerate_by_year(year)
        while some := list(itertools.islice(rows, 1 << 14)):
            columns = zip(*some, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(columns, _LISTED_ARROW, strict=True)], [n for n, _ in _LISTED_ARROW])

    def fetch(self, case_id: str) -> tuple | None:
        raise NotImplementedError

    def courts(self) -> list[tuple[str, str]]:
        return []

    def journals(self) -> list[tuple[str, str]]:
        return []


class SampleConnector(Connector):
    """Generated cases, ten a year, for examples and tests."""

    name = "sample"

    def authenticate(self) -> bool:
        return True

    def search(self, query: str, **options) -> Iterator[tuple]:
        for k in (1, 2):
            yield f"case_{k:03d}", f"Result {k} for {query}", 2024

    def enumerate_by_year(self, year: int) -> Iterator[tuple]:
        for k in range(1, 11):
            yield f"case_{year}_{k:03d}", f"Case {k} of {year}", year

    def fetch(self, case_id: str) -> tuple | None:
        _, year, number = case_id.split("_")
        text = f"Judgment number {number} of the year {year}. " * 5
        return case_id, f"Case {int(number)} of {year}", f"{year} SC {int(number)}", "Supreme Court", f"{year}-01-15", int(year), ["Justice A", "Justice B"], text, "Held."

    def courts(self) -> list[tuple[str, str]]:
        return [("sc", "Supreme Court"), ("hc", "High Court")]

    def journals(self) -> list[tuple[str, str]]:
        return [("lr", "Law Reports")]


class OrdersConnector(Connector):
    """A collection kept as a Parquet file of orders, at the option `path`, which the executors can open; an order is a case of its date's year."""

    name = "orders"

    def authenticate(self) -> bool:
        return True

    def batches_by_year(self, year: int) -> Iterator[pa.RecordBatch]:
        table = dataset.dataset(self.options["path"], format="parquet")
        date = dataset.field("o_orderdate")
        first, last = (pa.scalar(datetime.datetime(y, 1, 1), table.schema.field("o_orderdate").type) for y in (year, year + 1))
        for batch in table.to_batches(columns=["o_orderkey", "o_orderpriority"], filter=(date >= first) & (date < last)):
            if batch.num_rows:
                ids = pa.compute.cast(batch.column("o_orderkey"), pa.string())
                years = pa.array(np.full(batch.num_rows, year, np.int32))
                yield pa.RecordBatch.from_arrays([ids, batch.column("o_orderpriority"), years], [n for n, _ in _LISTED_ARROW])

    def enumerate_by_year(self, year: int) -> Iterator[tuple]:
        for batch in self.batches_by_year(year):
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


CONNECTORS: dict[str, type[Connector]] = {c.name: c for c in (SampleConnector, OrdersConnector)}


def connector(name: str, **options: str) -> Connector:
    if name not in CONNECTORS:
        raise ValueError(f"unknown connector {name!r}; there are {sorted(CONNECTORS)}")
    return CONNECTORS[name](**options)


@dataclass
class _Year(InputPartition):
    year: int


#: How a condition on the year bounds the years: (least, most) of its value.
_BOUNDS = {
    EqualTo: lambda v: (v, v),
    GreaterThan: lambda v: (v + 1, None),
    GreaterThanOrEqual: lambda v: (v, None),
    LessThan: lambda v: (None, v - 1),
    LessThanOrEqual: lambda v: (None, v),
}


class _Reader(DataSourceReader):
    def __init__(self, options: dict, detailed: bool):
        self.name, self.detailed = options.get("connector", SampleConnector.name), detailed
        self.options = {k: v for k, v in options.items() if k not in ("connector", "from", "to", "detail")}
        first, last = int(options.get("from", 2024)), int(options.get("to", options.get("from", 2024)))
        self.years = list(range(first, last + 1))

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Keeps the years that conditions on `year` leave, and takes those conditions over; the others are Spark's."""
        for condition in filters:
            if getattr(condition, "attribute", None) != ("year",):
                yield condition
            elif isinstance(condition, In):
                self.years = [y for y in self.years if y in condition.value]
            elif type(condition) in _BOUNDS:
                least, most = _BOUNDS[type(condition)](condition.value)
                self.years = [y for y in self.years if (least is None or y >= least) and (most is None or y <= most)]
            elif not isinstance(condition, IsNotNull):  # a listed case always has a year
                yield condition

    def partitions(self) -> list[InputPartition]:
        return [_Year(y) for y in self.years]

    def read(self, partition: _Year) -> Iterator[tuple] | Iterator[pa.RecordBatch]:
        own = connector(self.name, **self.options)
        return self._detailed(own, partition.year) if self.detailed else own.batches_by_year(partition.year)

    def _detailed(self, own: Connector, year: int) -> Iterator[tuple]:
        for row in own.enumerate_by_year(year):
            if (case := own.fetch(row[0])) is not None:
                yield case


class CaseSource(DataSource):
    """format("cases"), options connector, from, to and detail (true: whole cases)."""

    @classmethod
    def name(cls) -> str:
        return "cases"

    def schema(self) -> str:
        return DETAILED if self.options.get("detail", "false") == "true" else LISTED

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options), self.options.get("detail", "false") == "true")


def enumerate_years(spark: SparkSession, name: str, first: int, last: int, detail: bool = False, **options: str) -> DataFrame:
    """The cases of these years; a condition on `year` leaves years out of the plan, for which the session's push-down is turned on."""
    connector(name, **options)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(CaseSource)
    reader = spark.read.format("cases").options(**options).option("connector", name).option("from", first).option("to", last)
    return reader.option("detail", str(detail).lower()).load()


def fetched(ids: DataFrame, name: str) -> DataFrame:
    """The whole cases of the column `id`, fetched by Spark's tasks in parallel; what the connector does not have is left out.

    One request an id: whoever has a budget deals out no more ids, see sources/batches.py.
    """
    connector(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with connector(name) as own:
            for batch in batches:
                rows = []
                for case_id in batch.column("id").to_pylist():
                    if (case := own.fetch(case_id)) is not None:
                        rows.append(case)
                columns = zip(*rows, strict=True) if rows else [()] * len(_DETAILED_ARROW)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(columns, _DETAILED_ARROW, strict=True)], [n for n, _ in _DETAILED_ARROW])

    return ids.select(F.col("id").cast("string").alias("id")).mapInArrow(run, DETAILED)


#: LISTED and DETAILED as Arrow's types.
_LISTED_ARROW = [("id", pa.string()), ("title", pa.string()), ("year", pa.int32())]
_DETAILED_ARROW = [
    (n, {"int": pa.int32(), "array<string>": pa.list_(pa.string())}.get(t, pa.string())) for n, t in (f.split(" ", 1) for f in DETAILED.split(", "))
]


def listed_years(spark: SparkSession, first: int, last: int, per_year: int = 10) -> DataFrame:
    """What the sample connector lists, as a native plan."""
    years = spark.range(first, last + 1).select(F.col("id").cast("int").alias("year"))
    each = years.select("year", F.explode(F.sequence(F.lit(1), F.lit(per_year))).alias("k"))
    return each.select(F.format_string("case_%d_%03d", "year", "k").alias("id"), F.format_string("Case %d of %d", "k", "year").alias("title"), "year")

"""Columns computed by tasks beside whatever columns a table has."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Batches = Iterator[pa.RecordBatch]


def add_column(
    rows: DataFrame, of: str, out: str, kind: T.DataType, run: Callable[[Batches], Iterator[tuple[pa.RecordBatch, pa.Array]]]
) -> DataFrame:
    """All rows and columns with ``out`` last; a column of that name is replaced.

    ``run`` gets batches with ``of`` under that very name and yields parts of them with the values of ``out``. Names of
    other columns may be anything: inside they are numbers. Every column travels once, ``of`` too.
    """
    names = [c for c in rows.columns if c.lower() != out.lower()]
    inner = {c: "of" if c == of else f"c{i}" for i, c in enumerate(names)}
    sent = [F.col(f"`{c}`").alias(inner[c]) for c in names]
    if of not in inner:
        sent.append(F.col(f"`{of}`").alias("of"))
    numbered = rows.select(*sent)
    fields = [T.StructField(inner[c], numbered.schema[inner[c]].dataType) for c in names]
    schema = T.StructType([*fields, T.StructField("out", kind)])

    def mapped(batches: Batches) -> Batches:
        for part, column in run(batches):
            yield pa.RecordBatch.from_arrays([*part.columns[: len(fields)], column], schema.fieldNames())

    return numbered.mapInArrow(mapped, schema).toDF(*names, out)


def as_bytes(column: pa.Array) -> pa.Array:
    """Texts as their UTF-8, without a copy."""
    return column.cast(pa.binary())

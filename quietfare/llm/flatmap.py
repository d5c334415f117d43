"""Rows from texts: a function of each text, its results as flat Arrow columns beside the row's keys."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietfare.session import spread


def text_rows(df: DataFrame, text: str, keep: Sequence[str], find: Callable[[str], Sequence[tuple]], schema: str, types: Sequence[pa.DataType]) -> DataFrame:
    """``keep`` and one row per tuple that ``find`` gives for a row's whole text.

    Rows with null or empty text are left out before Python; nothing is shuffled,
    but for a scan of fewer partitions than cores. ``schema`` and ``types``
    describe the tuples.
    """
    source = spread(df.select(*keep, F.col(text).alias("_text")).where(F.length("_text") > 0))
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            found = [find(t) for t in texts]
            rows = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
            flat = [x for of in found for x in of]
            values = list(zip(*flat, strict=True)) if flat else [()] * len(names)
            columns = [batch.column(i).take(rows) for i in range(len(keep))]
            columns += [pa.array(v, t) for v, t in zip(values, types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *names])

    kept = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    return source.mapInArrow(run, f"{kept}, {schema}")

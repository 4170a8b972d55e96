"""Rows out of texts: a Python function over each text, without a shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.session import spread, text_batches


def text_rows(df: DataFrame, keys: Sequence[str], texts: Sequence[str], make: Callable[..., Sequence[tuple]], schema: str, names: Sequence[str], kinds: Sequence[pa.DataType]) -> DataFrame:
    """``keys`` of each row with every tuple that ``make(*texts)`` gives for it; ``schema`` and ``kinds`` are of the tuples."""
    text_batches(df.sparkSession)
    fields = [df.schema[k] for k in keys]
    out = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in fields), schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, made = [], []
            for i, row in enumerate(zip(*(b.column(t).to_pylist() for t in texts))):
                found = make(*row)
                at.extend([i] * len(found))
                made.extend(found)
            columns = [pa.array(c, k) for c, k in zip(zip(*made), kinds)] if made else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([*(b.column(k).take(pa.array(at, pa.int64())) for k in keys), *columns], names=[*keys, *names])

    return spread(df.select(*keys, *texts)).mapInArrow(run, out)

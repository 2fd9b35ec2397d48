"""Narrow passes that add columns to rows of any columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import batches


def add_columns(df: DataFrame, text_col: str, added: dict[str, str], compute: Callable[[list[str | None]], list[np.ndarray]]) -> DataFrame:
    """df with the columns ``added`` (name: type) computed from its text in bounded batches; columns of df
    with such a name give way. Rows stay where they are."""
    rest = [c for c in df.columns if c not in added]
    frame = df.select(*[F.col(f"`{c}`") for c in rest])
    schema = T.StructType([*frame.schema.fields, *T._parse_datatype_string(", ".join(f"{k} {v}" for k, v in added.items())).fields])
    at = rest.index(text_col)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for b in batches(whole, at):
                out = compute(b.column(at).cast(pa.string()).to_pylist())
                yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, out)], [*b.schema.names, *added])

    return frame.mapInArrow(run, schema)

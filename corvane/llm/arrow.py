"""Arrow plumbing for operators whose inner work is Python over whole column batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ..operators.durable import durable  # noqa: F401 - used through this module

#: Rows handled at once; keeps Python strings and results of one batch small beside an executor's memory.
CHUNK = 1024


def map_rows(df: DataFrame, make: Callable[[], Callable[[dict[str, list]], dict[str, list]]], schema: str, arrow: pa.Schema) -> DataFrame:
    """Applies a function on column lists to every chunk of rows, without a shuffle.

    make() is called once a task and returns the function, which may keep caches between chunks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for k in range(0, batch.num_rows, CHUNK):
                out = work(batch.slice(k, CHUNK).to_pydict())
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, f.type) for f, x in ((f, out[f.name]) for f in arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


class Memo(dict):
    """A cache that forgets everything when it is full; results never depend on it."""

    def __init__(self, make: Callable, most: int = 400_000):
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value

"""Greedy gap filter: keep the first event of a key, drop those within the gap of the last kept one, keep the next.

Greedy choice is sequential within a key. The rows are dealt by key and sorted by (key, time) once, which
spills; a pass over the sorted rows carries only the time of the last kept one, so memory does not depend on
how many rows a key has. A key's rows are one task's, as each choice rests on the one before.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_after_gap(rows: DataFrame, key: str, time: str, tie: str, gap: int, inclusive: bool = True, free: Column | None = None) -> DataFrame:
    """The kept rows of the greedy filter.

    inclusive: an event exactly `gap` after the last kept one is kept. free: rows where it is true are kept
    in any case and hold nothing back.
    """
    schema, least, some_free = rows.schema, gap if inclusive else gap + 1, free is not None
    if some_free:
        rows = rows.withColumn("__free", F.coalesce(free, F.lit(False)))
    names = rows.columns
    at, when, out = names.index(key), names.index(time), len(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, last = object(), 0
        for batch in batches:
            keys, times = batch.column(at).to_pylist(), batch.column(when).to_pylist()
            frees = batch.column(out).to_pylist() if some_free else [False] * len(keys)
            keep = []
            for k, t, f in zip(keys, times, frees, strict=True):
                ok = f or k != last_key or t - last >= least
                keep.append(ok)
                if ok and not f:
                    last_key, last = k, t
            yield batch.filter(pa.array(keep, pa.bool_())).select(names[:out])

    return rows.repartition(key).sortWithinPartitions(key, time, tie).mapInArrow(run, schema)

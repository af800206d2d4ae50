"""Reduction inside input partitions, before a stream is shuffled to its state.

A key that holds a large part of the rows then reaches its state task as a few rows per input batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame


def keep_edge(df: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool = False) -> DataFrame:
    """First (or last) row by ``order`` per key of each Arrow batch. Apply the watermark afterwards.

    Columns stay Arrow columns, so whole numbers beside nulls keep all their digits.
    """
    ks, by, edge = list(keys), [(c, "ascending") for c in order], "max" if last else "min"

    def reduce_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([batch]).sort_by(by)
            numbered = rows.append_column("_row", pa.array(range(rows.num_rows), pa.int64()))
            chosen = numbered.group_by(ks).aggregate([("_row", edge)]).column(f"_row_{edge}").combine_chunks()
            yield from rows.take(chosen.sort()).to_batches()

    return df.mapInArrow(reduce_batches, df.schema)

"""Distributed Gram matrix of sparse rows: the shared core of pair counting and factorization.

Both "how many customers bought i and j" and the spend matrix's AᵀA are sums over customers of products of two
cells. A self-join would emit every pair of every basket; here each task multiplies blocks of its rows with
numpy and emits only summed cells, which Spark combines again before and after the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 1024  # columns per block: one product block is 8 MB
CHUNK = 4096  # rows multiplied at a time
HELD_CELLS = 4_000_000  # cells a task gathers (about 80 MB) before it sums each block pair over them


def pack_rows(cells: DataFrame, row: str, column: str, value: str | None = None) -> DataFrame:
    """One row per ``row`` key: its column numbers ``idx`` and values ``val`` (ones when ``value`` is not given).

    ``cells`` must hold each (row, column) once, so an array is no longer than the number of columns.
    """
    cell = F.struct(F.col(column).cast("int").alias("i"), (F.col(value) if value else F.lit(1)).cast("double").alias("v"))
    packed = cells.groupBy(row).agg(F.collect_list(cell).alias("_cells"))
    return packed.select(row, F.col("_cells.i").alias("idx"), F.col("_cells.v").alias("val"))


def unpack(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, column numbers and values of a batch with list columns ``idx`` and ``val``."""
    idx, val = batch.column("idx"), batch.column("val")
    lengths = np.diff(idx.offsets.to_numpy())
    rows = np.repeat(np.arange(len(lengths)), lengths)
    return rows, idx.flatten().to_numpy(), val.flatten().to_numpy()


_CELLS = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("x", pa.float64())])


def _emit(first: int, second: int, block: np.ndarray) -> pa.RecordBatch:
    i, j = np.nonzero(np.triu(block) if first == second else block)
    columns = [(i + first * BLOCK).astype(np.int32), (j + second * BLOCK).astype(np.int32), block[i, j]]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_CELLS)


def _dense(rows: np.ndarray, cols: np.ndarray, vals: np.ndarray, height: int) -> np.ndarray:
    part = np.zeros((height, int(cols.max()) % BLOCK + 1))
    part[rows, cols % BLOCK] = vals
    return part


class _Rows:
    """Some rows' cells, cut into chunks of CHUNK rows and those by column block."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, vals: np.ndarray):
        order = np.lexsort((cols, cols // BLOCK, rows // CHUNK))
        rows, cols, vals = rows[order], cols[order], vals[order]
        key = (rows // CHUNK) * (int(cols.max(initial=0)) // BLOCK + 1) + cols // BLOCK
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(key)) + 1, [len(key)]))
        self.parts: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for s, e in zip(cuts, cuts[1:]):
            if e > s:
                self.parts[int(rows[s]) // CHUNK, int(cols[s]) // BLOCK] = rows[s:e], cols[s:e], vals[s:e]
        self.chunks = sorted({chunk for chunk, _ in self.parts})
        self.blocks = sorted({block for _, block in self.parts})

    def product(self, first: int, second: int) -> np.ndarray | None:
        """The sum over all rows for one pair of column blocks; two dense blocks exist at a time."""
        total = None
        for chunk in self.chunks:
            mine, theirs = self.parts.get((chunk, first)), self.parts.get((chunk, second))
            if mine is None or theirs is None:
                continue
            # Only rows with a cell in the first block matter.
            used, left_rows = np.unique(mine[0], return_inverse=True)
            left = _dense(left_rows, mine[1], mine[2], len(used))
            if first == second:
                right = left
            else:
                here = np.isin(theirs[0], used)
                if not here.any():
                    continue
                right = _dense(np.searchsorted(used, theirs[0][here]), theirs[1][here], theirs[2][here], len(used))
            part = left.T @ right
            if total is None:
                total = np.zeros((BLOCK, BLOCK))
            total[: part.shape[0], : part.shape[1]] += part
        return total


def _block_products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells are gathered up to HELD_CELLS; then each block pair is summed over all of them and emitted once."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    n_rows = n_cells = 0

    def sums() -> Iterator[pa.RecordBatch]:
        rows = _Rows(*(np.concatenate(parts) for parts in zip(*held)))
        for i, first in enumerate(rows.blocks):
            for second in rows.blocks[i:]:
                total = rows.product(first, second)
                if total is not None:
                    yield _emit(first, second, total)

    for batch in batches:
        rows, cols, vals = unpack(batch)
        held.append((rows + n_rows, cols, vals))
        n_rows, n_cells = n_rows + batch.num_rows, n_cells + len(cols)
        if n_cells >= HELD_CELLS:
            yield from sums()
            held, n_rows, n_cells = [], 0, 0
    if n_cells:
        yield from sums()


def gram(rows: DataFrame) -> DataFrame:
    """Upper triangle (``i`` <= ``j``) of the Gram matrix of packed rows, as cells ``(i, j, x)``."""
    partial = rows.select("idx", "val").mapInArrow(_block_products, "i int, j int, x double")
    return partial.groupBy("i", "j").agg(F.sum("x").alias("x"))

"""Whole-number vectors of embeddings, dealt to blocks of rows that queries stream past: packing, exact inner
products, highest scores.

A component x becomes floor(256 * x). A vector is kept as packed integers of ``width`` bytes: 2 where all fit, else 8.
Scores are exact as long as no sum leaves 64 bits, which vectors of unit length are far from.

Defined results: rows without an id, without a vector, or with a null or non-finite component take no part; an empty
vector has the score 0 with every other. A shorter vector counts as filled up with zeros. An id names one row: of rows
that repeat an id, the one with the smallest width and bytes (after the other columns kept) stays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.llm.tables import staged
from postlake.llm.words import per_row

SCALE = 256
BLOCK_ROWS = 1 << 19  # rows of a block at most, about
SCORES = 1 << 22  # scores held at once


def integers(column: pa.Array) -> list[np.ndarray | None]:
    """The whole numbers of each vector of a list column; None for one that takes no part."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    scaled = np.floor(SCALE * flat)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    usable = (per_row(~np.isfinite(flat), offsets) == 0) & pc.is_valid(column).to_numpy(zero_copy_only=False)
    whole = np.clip(np.nan_to_num(scaled), -(2.0**63), 2.0**63 - 1024).astype(np.int64)
    return [whole[a:b] if ok else None for a, b, ok in zip(offsets[:-1], offsets[1:], usable)]


def packed(vectors: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, ``width`` and ``data`` of the rows of ``vectors`` (``keep``, embedding) that take part, written to the
    shared folder. ``keep`` starts with the id."""
    feed = vectors.select(*keep, "embedding")
    kept = feed.select(*keep).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at, width, data = [], [], []
            for i, v in enumerate(integers(batch.column(len(keep)))):
                if v is not None:
                    narrow = not len(v) or (v.min() >= -32768 and v.max() <= 32767)
                    at.append(i)
                    width.append(2 if narrow else 8)
                    data.append(v.astype("<i2" if narrow else "<i8").tobytes())
            rows = batch.take(pa.array(at, pa.int64()))
            made = [pa.array(width, pa.int32()), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays([*rows.columns[: len(keep)], *made], [*keep, "width", "data"])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], "width int", "data binary"])
    out = feed.filter(F.col(keep[0]).isNotNull()).mapInArrow(run, schema)
    rest = [*keep[1:], "width", "data"]
    one = out.groupBy(keep[0]).agg(F.min(F.struct(*rest)).alias("r")).select(keep[0], "r.*")
    return staged(one, "vectors")


def first_copies(items: DataFrame, n: int, among: list[str]) -> DataFrame:
    """Rows with the ``n`` smallest ids of each group that agrees in ``among``. The limit acts before the shuffle too,
    so a group of any size moves ``n`` rows a task."""
    place = F.row_number().over(Window.partitionBy(*among).orderBy("vec_id"))
    return items.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")


def n_blocks(rows: DataFrame, queries: DataFrame, block_rows: int) -> int:
    """Blocks for ``rows``: of at most about ``block_rows``, and enough for all cores as long as the copies of the
    queries, one for each block, stay fewer than the rows."""
    n, asked = rows.count(), queries.count()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-n // block_rows), min(4 * cores, n // max(1, asked)))


def in_blocks(rows: DataFrame, queries: DataFrame, run: Callable, schema: str, order: tuple[str, ...] = ("id",)) -> DataFrame:
    """``run`` over every block of rows and the queries sent to it, both of them (block, label, id, width, data), the
    queries with ``given`` (array<long>) too. A task holds one block at a time, in ``order``; queries stream past it."""
    columns = ["block", "rank", "label", "id", "width", "data", "given"]
    none = F.lit(None).cast("array<long>")
    held = rows.withColumns({"rank": F.lit(0), "given": none}).select(*columns)
    every = held.union(queries.withColumn("rank", F.lit(1)).select(*columns))
    parts = 2 * rows.sparkSession.sparkContext.defaultParallelism
    dealt = every.repartition(max(parts, int(every.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "block")
    return dealt.sortWithinPartitions("block", "rank", *order).mapInArrow(run, schema)


def deal(items: DataFrame, blocks: int) -> Column:
    return F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block")


def to_all(blocks: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block")


def matrix(width: pa.Array, data: pa.Array) -> np.ndarray:
    """Vectors as rows, shorter ones filled up with zeros."""
    widths, values = width.to_numpy(), data.to_pylist()
    sizes = {len(v) for v in values}
    if len(sizes) == 1 and (widths == 2).all():
        return np.frombuffer(b"".join(values), "<i2").reshape(len(values), -1)
    vectors = [np.frombuffer(v, "<i2" if w == 2 else "<i8") for v, w in zip(values, widths.tolist())]
    out = np.zeros((len(values), max(map(len, vectors), default=0)), np.int64)
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return out


def _stacked(parts: list[np.ndarray]) -> np.ndarray:
    wide = max((p.shape[1] for p in parts), default=0)
    return np.concatenate([np.pad(p, ((0, 0), (0, wide - p.shape[1]))) for p in parts])


class Block:
    """The rows of a block, as sorted."""

    def __init__(self, batches: list[pa.RecordBatch]) -> None:
        self.label, self.id = (
            np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in batches]) if batches else np.zeros(0, np.int64)
            for i in (2, 3)
        )
        self.rows = _stacked([matrix(b.column(4), b.column(5)) for b in batches]) if batches else np.zeros((0, 0), np.int16)
        self.largest = float(np.abs(self.rows.astype(np.float64)).max(initial=0))
        self.kept: dict[str, np.ndarray] = {}

    def scores(self, vectors: np.ndarray, at: slice | np.ndarray = slice(None)) -> np.ndarray:
        """Exact inner products, one line for each of ``vectors``: as floats where no sum can pass what these hold
        exactly, else as 64-bit integers."""
        wide = min(self.rows.shape[1], vectors.shape[1])
        bound = self.largest * float(np.abs(vectors.astype(np.float64)).max(initial=0)) * wide
        kind = "f4" if bound < 2**24 else "f8" if bound < 2**53 else "i8"
        if kind not in self.kept:
            self.kept = {kind: self.rows.astype(kind)}
        return vectors[:, :wide].astype(kind) @ self.kept[kind][at, :wide].T

    def chunk(self) -> int:
        """Queries to score at once."""
        return max(1, SCORES // max(1, len(self.id)))


def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Block, pa.RecordBatch]]:
    """(block number, block, some of its queries) from sorted batches."""
    now, held, block = None, [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = 2 * batch.column(0).to_numpy() + batch.column(1).to_numpy()
        cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            number, rank = divmod(int(key[a]), 2)
            if number != now:
                now, held, block = number, [], None
            if rank == 0:
                held.append(batch.slice(a, b - a))
                continue
            if block is None:
                block, held = Block(held), []
            step = block.chunk()
            for low in range(a, b, step):
                yield number, block, batch.slice(low, min(step, b - low))


def first(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores, highest first, ties to smaller positions."""
    at = np.arange(len(scores))
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > edge)
        at = np.concatenate([above, np.flatnonzero(scores == edge)[: k - len(above)]])
    return at[np.lexsort((at, -scores[at]))]

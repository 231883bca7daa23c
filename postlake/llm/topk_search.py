"""Exact top-k search by inner product with a three-phase uniform threshold.

The components are cut into ``SLICES`` ranges; a score is the sum of its slices' partial scores, and a slice of a block of
rows is a node that knows its own partial scores alone. For each query:

1. Every node reports its ``k`` highest partial scores and its smallest. Sums of the reported ones over the smallest
   partial score of their slice (the floor) are lower bounds of whole scores; the k-th highest is a safe cutoff.
2. The cutoff, divided evenly between the slices, goes to all nodes: whatever reaches the cutoff as a whole reaches that
   share in some slice. Nodes report every row that does. Rows whose bound from what is known stays below the
   k-th highest lower bound drop out.
3. The remaining rows get their scores from whole vectors, in the blocks that hold them.

A node with more than ``DENSE`` such rows for a query reports itself in their place, and phase 3 scores its block for
that query: many rows at one height cost k rows a block, none is left out. Of equal vectors only the ``k + 1`` smallest ids
can be among k results (one may be the query's own), so others are set aside before.

Queries are copied to every block, rows are not; blocks hold up to ``BLOCK_ROWS`` rows. See ``vectors`` for rows that
take no part and for repeated ids. A query without other rows has no result; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlake.llm import vectors
from postlake.llm.tables import staged, table
from postlake.llm.vectors import Block, cells, first, first_copies, in_blocks, matrix, n_blocks, packed

SLICES = 2
DENSE = 64
K = 5
EVERY = 50

_LONGS = pa.list_(pa.int64())


def _partial(block: Block, queries: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Query's place in the batch, partial scores of the rows but its own, and their positions."""
    found = block.scores(matrix(queries.column(4), queries.column(5)))
    for i, own in enumerate(queries.column(3).to_numpy()):
        at = np.flatnonzero(block.id != own)
        if len(at):
            yield i, found[i] if len(at) == len(block.id) else found[i][at], at


def _highest(k: int, slices: int):
    """Phase 1 in a node: (query_id, slice, least, ids, parts)."""

    def run(batches):
        for number, block, queries in cells(batches):
            out = [[], [], [], [], []]
            asked = queries.column(3).to_pylist()
            for i, part, at in _partial(block, queries):
                best = first(part, k)
                row = (asked[i], number % slices, int(part.min()), block.id[at[best]], part[best].astype(np.int64))
                for column, value in zip(out, row):
                    column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), _LONGS, _LONGS]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], list("abcde"))

    return run


def _reaching(slices: int):
    """Phase 2 in a node, ``given`` the cutoff and the floors: (query_id, block, slice, ids, parts); ids null if many."""

    def run(batches):
        for number, block, queries in cells(batches):
            out = [[], [], [], [], []]
            asked, given = queries.column(3).to_pylist(), queries.column(6).to_pylist()
            for i, part, at in _partial(block, queries):
                cutoff, floor = given[i][0], given[i][1 + number % slices]
                # part - floor >= cutoff / slices, in whole numbers
                share = floor - (-cutoff // slices)
                high = np.flatnonzero(part >= share)
                if len(high):
                    many = len(high) > DENSE
                    ids, parts = ([], []) if many else (block.id[at[high]], part[high].astype(np.int64))
                    row = (asked[i], number // slices, number % slices, None if many else ids, parts)
                    for column, value in zip(out, row):
                        column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int32(), _LONGS, _LONGS]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], list("abcde"))

    return run


def _resolved(k: int):
    """Phase 3 in a block, ``given`` the ids to score, or null for all: its highest scores (query_id, ids, scores)."""

    def run(batches):
        for _, block, queries in cells(batches):
            out = [[], [], []]
            order = np.argsort(block.id)
            by_id = block.id[order]
            lines = matrix(queries.column(4), queries.column(5))
            for i, (own, given) in enumerate(zip(queries.column(3).to_pylist(), queries.column(6).to_pylist())):
                if given is None:
                    at = order[by_id != own]
                else:
                    at = order[np.searchsorted(by_id, np.sort(np.array(given, np.int64)))]
                if len(at):
                    found = block.scores(lines[i : i + 1], at)[0]
                    best = first(found, k)
                    for column, value in zip(out, (own, block.id[at[best]], found[best].astype(np.int64))):
                        column.append(value)
            kinds = [pa.int64(), _LONGS, _LONGS]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], list("abc"))

    return run


def _slices(df: DataFrame, chunk: int, slices: int, block: Column | None = None) -> DataFrame:
    """A row for each slice; its node is block * slices + slice."""
    out = df if block is None else df.select("*", block)
    out = out.select("*", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"))
    cut = F.substring("data", 1 + F.col("width") * F.col("slice") * chunk, F.col("width") * chunk)
    return out.withColumns({"block": F.col("block") * slices + F.col("slice"), "data": cut, "label": F.lit(0)})


def _kth(lows: DataFrame, k: int) -> DataFrame:
    """(query_id, kth): the k-th highest ``low`` of each query, 0 if it has fewer."""
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("low").desc()))
    top = lows.withColumn("_place", place).filter(F.col("_place") <= k)
    return top.groupBy("query_id").agg(F.max(F.when(F.col("_place") == k, F.col("low"))).alias("kth")).na.fill(0, ["kth"])


def _entries(lists: DataFrame, floors: DataFrame) -> DataFrame:
    """Reported rows (query_id, block, vec_id, over): partial scores over the floor of their slice."""
    each = lists.select("query_id", "block", "slice", F.explode(F.arrays_zip("ids", "parts")).alias("e"))
    over = F.col("e.parts") - F.element_at("floors", F.col("slice") + 1)
    return each.join(floors, "query_id").select("query_id", "block", F.col("e.ids").alias("vec_id"), over.alias("over"))


def top_k(items: DataFrame, asked: DataFrame, k: int = K, slices: int = SLICES) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``asked`` the ``k`` highest of the rows of ``items`` but its own.

    Both are (vec_id, width, data) as :func:`vectors.packed` gives them.
    """
    items = staged(first_copies(items, k + 1, ["width", "data"]), "items")
    blocks = n_blocks(items, asked, vectors.BLOCK_ROWS)
    dims = items.agg(F.max(F.octet_length("data") / F.col("width"))).first()[0] or 0
    chunk = max(1, -(-int(dims) // slices))
    block = vectors.deal(items, blocks)
    rows = _slices(items.select("*", block), chunk, slices).withColumnRenamed("vec_id", "id")
    none = F.lit(None).cast("array<long>").alias("given")

    def to_nodes(queries: DataFrame) -> DataFrame:
        return _slices(queries, chunk, slices, vectors.to_all(blocks)).withColumnRenamed("vec_id", "id")

    schema = "query_id long, slice int, least long, ids array<long>, parts array<long>"
    lists = staged(in_blocks(rows, to_nodes(asked.select("*", none)), _highest(k, slices), schema), "lists")
    least = [F.min(F.when(F.col("slice") == j, F.col("least"))) for j in range(slices)]
    floors = lists.groupBy("query_id").agg(F.array(*least).alias("floors"))
    lows = _entries(lists.withColumn("block", F.lit(0)), floors).groupBy("query_id", "vec_id").agg(F.sum("over").alias("low"))
    cutoffs = staged(floors.join(_kth(lows, k), "query_id").withColumnRenamed("kth", "cutoff"), "cutoffs")

    given = F.concat(F.array("cutoff"), "floors").alias("given")
    told = asked.join(cutoffs.select(F.col("query_id").alias("vec_id"), given), "vec_id")
    schema = "query_id long, block long, slice int, ids array<long>, parts array<long>"
    reached = staged(in_blocks(rows, to_nodes(told), _reaching(slices), schema), "reached")
    entries = _entries(reached, cutoffs.select("query_id", "floors"))
    bounds = entries.groupBy("query_id", "vec_id").agg(
        F.sum("over").alias("low"), F.count("*").alias("seen"), F.first("block").alias("block")
    )
    bounds = staged(bounds, "bounds")
    better = _kth(bounds, k).join(cutoffs.select("query_id", "cutoff"), "query_id")
    better = better.select("query_id", "cutoff", F.greatest("kth", "cutoff").alias("edge"))
    # an unseen slice adds less than its share of the cutoff
    missing = slices - F.col("seen")
    most = slices * F.col("low") + missing * F.col("cutoff")
    open_ = F.when(missing == 0, most >= slices * F.col("edge")).otherwise(most > slices * F.col("edge"))
    left = bounds.join(better, "query_id").filter(open_).select("query_id", "block", "vec_id")
    dense = reached.filter("ids IS NULL").select("query_id", "block", F.lit(None).cast("long").alias("vec_id"))
    wanted = left.union(dense).groupBy("query_id", "block").agg(
        F.when(F.count("*") == F.count("vec_id"), F.collect_list("vec_id")).alias("given")
    )
    label = F.lit(0).alias("label")
    asks = asked.withColumnRenamed("vec_id", "id").join(wanted.withColumnRenamed("query_id", "id"), "id").select("*", label)
    whole = items.select(block, label, F.col("vec_id").alias("id"), "width", "data")
    found = in_blocks(whole, asks, _resolved(k), "query_id long, ids array<long>, scores array<long>")
    each = found.select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("e"))
    each = each.select("query_id", F.col("e.ids").alias("vec_id"), F.col("e.scores").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return each.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(embeddings: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """:func:`top_k` of the rows of ``embeddings`` (vec_id, embedding) that are queries, against all its rows."""
    items = packed(embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding"), ["vec_id"])
    return top_k(items, items.filter(is_query), k)


def op13_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest scores of every 50th row of ``embeddings``."""
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)

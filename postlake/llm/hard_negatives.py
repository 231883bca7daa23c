"""Hard negatives by slot-decomposed selection.

A negative of a pair (anchor, positive) is a row of another label whose score lies between ``LOWER`` and ``UPPER``
percent of the positive's. The windows of one anchor overlap, so they are not searched one by one:

1. Anchors meet the rows of their own label; the best ``POSITIVES`` are its positives.
2. The upper limits of its positives split the scores below the highest into disjoint slots. Each block of rows, and then
   each task before the shuffle, keeps the ``NEGATIVES`` highest of every slot: at most positives times negatives
   rows an anchor, however many rows tie or lie in a window.
3. Going down, the slots from a positive's own limit on hold all rows below that limit, so the first of their merge are its
   hardest; those below its lower limit end the list.

Anchors are copied to every block of rows, rows are not; within a block an anchor meets only the labels it asks for. See
``vectors`` for packing, rows that take no part and repeated ids; a null label takes no part either. Anchors without positives, pairs
without negatives and an empty table give no rows. Ties go to smaller ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlake.llm import vectors
from postlake.llm.tables import staged, table
from postlake.llm.vectors import cells, first, in_blocks, matrix, n_blocks, packed

POSITIVES, NEGATIVES = 5, 5
LOWER, UPPER = 80, 100  # percent of the positive's score
ANCHOR_EVERY = 100
RELABEL_EVERY, LABELS = 7, 10

_LONGS = pa.list_(pa.int64())


def _batch(columns: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), *[_LONGS] * (len(columns) - 1)]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], list("abcd")[: len(columns)])


def _own_label(k: int):
    """An anchor's best rows of its label in a block: (anchor_id, ids, scores). Rows and anchors come by label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block, anchors in cells(batches):
            out = [[], [], []]
            labels, own = anchors.column(2).to_numpy(), anchors.column(3).to_numpy()
            lines = matrix(anchors.column(4), anchors.column(5))
            for label in np.unique(labels):
                rows = slice(*np.searchsorted(block.label, [label, label + 1]))
                asked = np.flatnonzero(labels == label)
                if rows.start == rows.stop:
                    continue
                for i, scores in zip(asked.tolist(), block.scores(lines[asked], rows)):
                    at = np.flatnonzero(block.id[rows] != own[i])
                    best = at[first(scores[at], k)]
                    if len(best):
                        for column, value in zip(out, (own[i], block.id[rows][best], scores[best].astype(np.int64))):
                            column.append(value)
            yield _batch(out)

    return run


def _by_slot(k: int):
    """The best rows of other labels in each slot: (anchor_id, slots, ids, scores). ``given`` holds the upper limits going
    down, then the lowest score that any window reaches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block, anchors in cells(batches):
            out = [[], [], [], []]
            labels, own, given = (anchors.column(i).to_pylist() for i in (2, 3, 6))
            found = block.scores(matrix(anchors.column(4), anchors.column(5)))
            for i, scores in enumerate(found):
                *limits, least = given[i]
                at = np.flatnonzero((scores <= limits[0]) & (scores >= least) & (block.label != labels[i]))
                # slot j: above limit j + 1, up to limit j
                slot = np.searchsorted(-np.array(limits), -scores[at], side="right") - 1
                slots, picked = [], []
                for j in np.unique(slot).tolist():
                    inside = at[slot == j]
                    best = inside[first(scores[inside], k)]
                    picked.append(best)
                    slots += [j] * len(best)
                if slots:
                    best = np.concatenate(picked)
                    for column, value in zip(out, (own[i], slots, block.id[best], scores[best].astype(np.int64))):
                        column.append(value)
            yield _batch(out)

    return run


def _at_most(percent: int) -> Column:
    """The largest whole number that is at most ``percent`` of the positive's score."""
    return F.expr(f"({percent} * positive_score - pmod({percent} * positive_score, 100L)) div 100")


def mine(
    items: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lower: int = LOWER,
    upper: int = UPPER,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows of ``items``
    (vec_id, label, width, data), as :func:`vectors.packed` gives them, that are anchors."""
    anchors = items.filter(is_anchor)
    blocks = n_blocks(items, anchors, vectors.BLOCK_ROWS)
    rows = items.withColumn("block", vectors.deal(items, blocks)).withColumnRenamed("vec_id", "id")

    def to_all(asked: DataFrame) -> DataFrame:
        return asked.select("*", vectors.to_all(blocks)).withColumnRenamed("vec_id", "id")

    none = F.lit(None).cast("array<long>").alias("given")
    schema = "anchor_id long, ids array<long>, scores array<long>"
    lists = in_blocks(rows, to_all(anchors.select("*", none)), _own_label(positives), schema, ("label", "id"))
    each = lists.select("anchor_id", F.explode(F.arrays_zip("ids", "scores")).alias("e"))
    place = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.col("e.scores").desc(), "e.ids"))
    best = each.withColumn("place", place).filter(F.col("place") <= positives)
    best = best.select("anchor_id", F.col("e.ids").alias("positive_id"), F.col("e.scores").alias("positive_score"))
    # a window without a whole number in it, as below a negative score, has no limit
    best = best.withColumns({"low": -_at_most(-lower), "high": _at_most(upper)})
    best = staged(best.filter("low <= high"), "positives")

    limits = best.groupBy("anchor_id").agg(
        F.reverse(F.array_sort(F.collect_set("high"))).alias("limits"), F.min("low").alias("least")
    )
    given = F.concat("limits", F.array("least")).alias("given")
    asked = anchors.join(limits.select(F.col("anchor_id").alias("vec_id"), given), "vec_id")
    schema = "anchor_id long, slots array<long>, ids array<long>, scores array<long>"
    lists = in_blocks(rows, to_all(asked), _by_slot(negatives), schema)
    each = lists.select("anchor_id", F.explode(F.arrays_zip("slots", "ids", "scores")).alias("e")).select(
        "anchor_id", F.col("e.slots").alias("slot"), F.col("e.ids").alias("id"), F.col("e.scores").alias("score")
    )
    place = F.row_number().over(Window.partitionBy("anchor_id", "slot").orderBy(F.col("score").desc(), "id"))
    kept = each.withColumn("place", place).filter(F.col("place") <= negatives)
    slots = kept.groupBy("anchor_id").agg(
        F.array_sort(F.collect_list(F.struct("slot", "place", "id", "score"))).alias("down")  # positives x negatives at most
    )
    pairs = best.join(slots, "anchor_id")
    below = F.slice(F.filter("down", lambda e: e["score"] <= F.col("high")), 1, negatives)
    inside = F.filter(below, lambda e: e["score"] >= F.col("low"))
    return pairs.select("anchor_id", "positive_id", "positive_score", F.posexplode(inside).alias("pos", "e")).select(
        "anchor_id",
        "positive_id",
        (F.col("pos") + 1).alias("rank"),
        F.col("e.id").alias("negative_id"),
        "positive_score",
        F.col("e.score").alias("negative_score"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five hard negatives of each of the five positives of every 100th row of ``embeddings``; every seventh is relabelled."""
    moved = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("long").alias("vec_id"), moved.cast("int").alias("label"), "embedding"
    )
    items = packed(rows.filter("label IS NOT NULL"), ["vec_id", "label"])
    return mine(items, F.col("vec_id") % ANCHOR_EVERY == 0)

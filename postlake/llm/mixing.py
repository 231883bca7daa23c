"""Mixing sources to target weights by temperature, in DataFrame operations only.

A source's weight is its share of all tokens to a power, normalised. The exponent is bisected: the entropy of the
weights falls as it rises, so it is found where the entropy meets ``target_entropy`` (a share of the largest possible);
if a source would then be repeated more than ``max_epochs`` times, it is moved towards 1 to where none is. Each round evaluates
``SECTION`` exponents in one aggregate over the table of sources, so only sums reach the driver.

Weights become rows within a budget of tokens: a source's quota is so many whole epochs of its documents and a rest.
For the rest the source's documents lie in blocks of about ``BLOCK_TOKENS``, and of about ``BLOCK_ROWS`` where texts are
empty or short, permuted by a hash; whole blocks are taken while they fit, and of the block at the edge the documents, in the order of a hash, while they fit. Running sums thus
cover the blocks of a source or the documents of one block, never all documents of a source. A word between white
space counts as a token.

Defined results: null and empty texts cost nothing and go with their source. A null source is a source. A source
without tokens has weight 0 and its rows no copies. With one source, or equal shares, any exponent gives the same
weights; 1 is taken if it meets the target. Repeated rows are mixed as separate rows; ties of the hash are broken by
nothing, as such rows are equal or cost the same order. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlake.llm.tables import staged, table

TARGET_ENTROPY = 0.95
MAX_EPOCHS = 4.0
BLOCK_TOKENS = 2_000_000
BLOCK_ROWS = 20_000
SECTION = 16
ROUNDS = 7
LARGEST_EXPONENT = 4.0


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """The source's name, told apart from a null."""
    return F.when(source.isNull(), F.lit("null")).otherwise(F.concat(F.lit("name:"), source.cast("string")))


def source_totals(rows: DataFrame) -> DataFrame:
    """(key, total, n_rows) of rows (key, tokens)."""
    return rows.groupBy("key").agg(F.sum("tokens").alias("total"), F.count(F.lit(1)).alias("n_rows"))


def _measured(shares: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """Entropy, and the largest ratio of a weight to its share, for each exponent."""
    log = F.log("share")
    columns = []
    for i, a in enumerate(exponents):
        power = F.exp(log * a)
        columns += [F.sum(power).alias(f"z{i}"), F.sum(power * log).alias(f"s{i}"), F.max(F.exp(log * (a - 1))).alias(f"m{i}")]
    row = shares.agg(*columns).first()
    out = []
    for i, a in enumerate(exponents):
        z = row[f"z{i}"]
        out.append((math.log(z) - a * row[f"s{i}"] / z, row[f"m{i}"] / z))
    return out


def _bisect(shares: DataFrame, wanted, low: float, high: float) -> float:
    """The edge in [low, high] up to which ``wanted(entropy, ratio)`` holds; ``SECTION`` points cut it at once."""
    for _ in range(ROUNDS):
        points = [low + (high - low) * (i + 1) / (SECTION + 1) for i in range(SECTION)]
        holds = [wanted(*m) for m in _measured(shares, points)]
        n = holds.index(False) if False in holds else SECTION
        low, high = ([low, *points][n], [*points, high][n])
    return (low + high) / 2


def exponent(totals: DataFrame, budget: float | None, target_entropy: float, max_epochs: float) -> tuple[float, float, float]:
    """The exponent, the sum of shares to its power, and all tokens; ``totals`` is (key, total)."""
    some = totals.filter("total > 0")
    everything, n = some.agg(F.sum("total"), F.count("*")).first()
    if not n:
        return 1.0, 1.0, 0.0
    everything = float(everything)
    shares = some.select((F.col("total") / everything).alias("share"))
    epochs = (everything if budget is None else budget) / everything
    goal = target_entropy * math.log(n)
    (at_one, _), (widest, _) = _measured(shares, [1.0, 0.0])
    if abs(at_one - goal) < 1e-9 or widest - at_one < 1e-12:
        found = 1.0
    else:
        found = _bisect(shares, lambda entropy, _: entropy >= goal, 0.0, LARGEST_EXPONENT)
    if epochs * _measured(shares, [found])[0][1] > max_epochs * (1 + 1e-9):
        # no exponent repeats less than 1 does, so the limit may be out of reach on both sides
        if found < 1:
            found = _bisect(shares, lambda _, ratio: epochs * ratio > max_epochs, found, 1.0)
        elif epochs > max_epochs:
            found = 1.0
        elif found > 1:
            # a hair below the limit, so that no rest is left for one more copy
            found = _bisect(shares, lambda _, ratio: epochs * ratio <= max_epochs * (1 - 1e-6), 1.0, found)
    power = shares.agg(F.sum(F.pow("share", F.lit(found)))).first()[0]
    return found, power, everything


def weights(totals: DataFrame, budget: float | None = None, target_entropy: float = TARGET_ENTROPY, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``totals`` (key, total, ...) with the weight, quota, epochs and rest of each source."""
    power, norm, everything = exponent(totals, budget, target_entropy, max_epochs)
    amount = everything if budget is None else float(budget)
    some = F.col("total") > 0
    share = F.col("total") / F.lit(max(everything, 1.0))
    out = totals.withColumn("weight", F.when(some, F.pow(share, F.lit(power)) / norm).otherwise(F.lit(0.0)))
    out = out.withColumn("quota", F.floor(F.col("weight") * amount + 1e-6))
    out = out.withColumn("epochs", F.when(some, F.floor(F.col("quota") / F.col("total"))).otherwise(F.lit(0)))
    return out.withColumn("rest", F.col("quota") - F.col("epochs") * F.col("total"))


def copies(rows: DataFrame, seed: int = 0, **target) -> DataFrame:
    """``rows`` (key, tokens, order and others) with weight, epochs and copies."""
    totals = staged(source_totals(rows), "totals")
    blocks = F.greatest(F.ceil(F.col("total") / BLOCK_TOKENS), F.ceil(F.col("n_rows") / BLOCK_ROWS))
    plan = staged(weights(totals, **target).withColumn("blocks", blocks), "weights")
    blocked = rows.join(plan.select("key", "blocks"), "key").withColumn(
        "block", F.pmod(F.xxhash64("order", F.lit(seed)), F.col("blocks"))
    )
    sums = blocked.groupBy("key", "block").agg(F.sum("tokens").alias("block_tokens"))
    before = Window.partitionBy("key").orderBy(F.xxhash64("key", "block", F.lit(seed)), "block")
    running = F.coalesce(F.sum("block_tokens").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    limits = (
        sums.withColumn("taken", running)
        .join(plan.select("key", "weight", "epochs", "rest"), "key")
        .select("key", "block", "weight", "epochs", (F.col("rest") - F.col("taken")).alias("room"), "taken")
    )
    inside = Window.partitionBy("key", "block").orderBy(F.xxhash64("order", F.lit(seed + 1)), "order")
    so_far = F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    out = blocked.join(limits, ["key", "block"]).withColumn("so_far", so_far)
    # an empty rest takes nothing, not even rows that cost nothing
    more = F.when((F.col("room") > 0) & (F.col("so_far") <= F.col("room")), 1).otherwise(0)
    return out.withColumn("copies", (F.col("epochs") + more).cast("long")).withColumn(
        "position", F.col("taken") + F.col("so_far") - F.col("tokens")
    )


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: tokens, its source's weight, copies in the mix, its place in an epoch of the source."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(
        "doc_id", "source", source_key(F.col("source")).alias("key"), token_count(F.col("text")).alias("tokens"),
        F.xxhash64("doc_id", "text").alias("order"),
    )
    mixed = copies(staged(rows, "counted"))
    return mixed.select("doc_id", "source", "tokens", "weight", "copies", "position")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document once for every copy, with its epoch and its place in the source's epoch."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    given = dict(zip(docs.columns, names))
    rows = docs.toDF(*names).withColumns(
        {
            "key": source_key(F.col(given["source"])),
            "tokens": token_count(F.col(given["text"])),
            "order": F.xxhash64(given["doc_id"], given["text"]),
        }
    )
    mixed = copies(rows).filter("copies > 0")
    mixed = mixed.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    added = [c for c in ("epoch", "position", "weight") if c not in docs.columns]
    return mixed.select(*[F.col(n).alias(c) for c, n in given.items()], *added)

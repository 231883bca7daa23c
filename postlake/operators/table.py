"""Stored posts: one parquet table per network, partitioned by symbol bucket and month.

A symbol is a value, not a table name, and its bucket is a hash of it, so ten thousand symbols make
a few hundred partitions a month. One writer per table at a time is assumed.
"""

from __future__ import annotations

import datetime as dt
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.functions.times import as_ts
from postlake.operators.project import require_valid
from postlake.operators.sizing import broadcast_if_small
from postlake.operators.stats import get_first
from postlake.schemas import stored_fields
from postlake.session import folder_bytes, remove_dir, shared_dir

PARTITION = ("symbol_bucket", "month")
SUMMARY = (
    "symbol string, n_rows bigint, oldest struct<datetime: timestamp, id: string>, newest struct<datetime: timestamp, id: string>"
)
DEFAULT_BUCKETS = 64
# Staged batches are read for writing in splits of this many bytes of uncompressed texts, so that a task sorts them in
# memory. A task's rows of one partition become a file of their own where these hold so many on average, else partitions are
# gathered first.
SPLIT_BYTES = 384 * 1024 * 1024
PIECE_BYTES = 2 * 1024 * 1024


def symbol_bucket(symbol: Column, n_buckets: int) -> Column:
    return F.pmod(F.xxhash64(symbol), F.lit(n_buckets)).cast("int")


def create_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    """Database for post tables; ``location`` must be a folder all executors reach."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")
    return name


def scratch_database(spark: SparkSession) -> str:
    """A database of its own in the shared work folder."""
    return create_database(spark, f"postlake_{uuid.uuid4().hex[:12]}", shared_dir(spark, "db"))


def first_versions(
    batch: DataFrame, keys: tuple[str, ...] = ("symbol", "id"), tie: Column | None = None
) -> DataFrame:
    """One row per key: the earliest by ``update_datetime``, then ``datetime``, then row hash (or ``tie``).

    An aggregate rather than a ranking window: copies are reduced before the shuffle, so a key that
    holds a third of the batch does not gather in one task.
    """
    rest = [c for c in batch.columns if c not in keys]
    order = F.struct("update_datetime", "datetime", F.xxhash64(*rest) if tie is None else tie)
    picked = batch.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("r"))
    return picked.select(*keys, "r.*").select(*batch.columns)


class PostTable:
    """Table of one network in a database."""

    def __init__(self, spark: SparkSession, database: str, network: str, n_buckets: int = DEFAULT_BUCKETS):
        self.spark = spark
        self.network = network
        self.fields = stored_fields(network)
        self.name = f"{database}.{network}"
        self.n_buckets = n_buckets

    @property
    def columns(self) -> list[str]:
        return [*[f.name for f in self.fields], "symbol"]

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def create(self) -> None:
        """Create the table if it is absent. Its overwrites are dynamic: they replace the partitions
        written to and no others, which a writer's own option would not bring about here."""
        stored = ", ".join(f"{f.name} {f.type}" for f in self.fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({stored}, symbol string, symbol_bucket int, month string) "
            f"USING parquet OPTIONS ('partitionOverwriteMode'='dynamic', 'compression'='zstd') "
            f"PARTITIONED BY ({', '.join(PARTITION)}) TBLPROPERTIES ('n_buckets'='{self.n_buckets}')"
        )
        made = self.spark.sql(f"SHOW TBLPROPERTIES {self.name} ('n_buckets')").first()["value"]
        if made != str(self.n_buckets):
            raise ValueError(f"{self.name} was created with {made} buckets, not {self.n_buckets}")

    def drop(self) -> None:
        """Drop the table with its key index, its summary and the folders that deletes moved partitions to."""
        moved = f"{self._root()}_versions" if self.exists() else None
        for name in (self.keys_name, self.summary_name, self.name):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        if moved:
            remove_dir(self.spark, moved)

    def read(self, symbols: list[str] | None = None) -> DataFrame:
        """Stored rows; with ``symbols`` only their buckets are scanned."""
        self.spark.catalog.refreshTable(self.name)
        rows = self.spark.table(self.name)
        return rows if symbols is None else rows.where(self._of_symbols(symbols))

    def _of_symbols(self, symbols: list[str]) -> Column:
        wanted = self.spark.range(1).select(
            F.explode(F.array(*[F.lit(s) for s in symbols])).alias("symbol")
        ).select(symbol_bucket(F.col("symbol"), self.n_buckets).alias("b")).distinct()
        buckets = [r["b"] for r in wanted.collect()]
        return F.col("symbol_bucket").isin(*buckets) & F.col("symbol").isin(*symbols)

    def _placed(self, rows: DataFrame) -> DataFrame:
        valid = require_valid(rows.select(*self.columns), self.network)
        return valid.withColumns(
            {
                "symbol_bucket": symbol_bucket(F.col("symbol"), self.n_buckets),
                "month": F.date_format("datetime", "yyyy-MM"),
            }
        )

    @staticmethod
    def _laid_out(rows: DataFrame) -> DataFrame:
        """Sort rows for writing, each task its own; by symbol inside a partition, so that row-group statistics find it."""
        return rows.sortWithinPartitions(*PARTITION, "symbol", "datetime")

    @staticmethod
    def _gathered(rows: DataFrame) -> DataFrame:
        """Shuffle rows by partition, so that small ones share a file. A hot one is split over several tasks."""
        return rows.hint("rebalance", *PARTITION)

    def insert_ignore(self, batch: DataFrame, stable_datetime: bool = False) -> int:
        """Append rows whose (symbol, id) is not stored yet, each once; returns how many.

        Rows missing a required value stop the job (see ``split_valid`` for setting them aside).
        Stored keys are looked up in the key index, in the buckets of the batch and between its smallest and largest
        id of each; no other column of the table is read. ``stable_datetime`` also limits them to the batch's months,
        which is exact as long as a post never changes its time. The batch is computed once, into the shared
        folder; nothing is kept in executors. Which of its rows are new is told from their keys alone, so texts are
        shuffled at most once, where partitions must be gathered (see ``PIECE_BYTES``), and else not at all.
        """
        self.create()
        self.repair_keys()
        work = shared_dir(self.spark, "insert")
        try:
            staged = self._staged(batch, f"{work}/batch")
            narrow = staged.select("symbol", "id", *PARTITION, "update_datetime", "datetime", "_hash", "_bytes", "_row")
            first = first_versions(narrow, tie=F.struct("_hash", "_row")).drop("update_datetime", "_hash")
            fresh = self._written(first, f"{work}/fresh")
            known = self._written(self._known_keys(fresh, stable_datetime), f"{work}/known")
            n_new = fresh.count() - known.count()
            if n_new:
                new = self._written(fresh.join(known, ["symbol", "id"], "left_anti"), f"{work}/new")
                with self._changing_keys():
                    self._append(staged, new, f"{work}/batch")
                    self._keys_laid_out(new).write.insertInto(self.keys_name)
                    self._add_to_summary(new, work)
            self.spark.catalog.refreshTable(self.name)
            return n_new
        finally:
            remove_dir(self.spark, work)

    def _staged(self, batch: DataFrame, path: str) -> DataFrame:
        """The batch's rows as they come, written once, with a row number, a hash and the size of their texts.

        Rows of one post under several symbols come together, and their texts take the room of one in a file.
        """
        placed = self._placed(batch)
        texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in self.fields if f.type == "string"]
        marked = placed.withColumns(
            {
                "_hash": F.xxhash64(*[c for c in placed.columns if c not in ("symbol", "id")]),
                "_bytes": sum(texts, F.lit(0)).cast("bigint"),
                "_row": F.monotonically_increasing_id(),
            }
        )
        schema = marked.schema
        # small row groups, since one holds far more text than its size in the file
        marked.write.option("compression", "zstd").option("parquet.block.size", 4 * 1024 * 1024).parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def _append(self, staged: DataFrame, new: DataFrame, path: str) -> None:
        """Write the staged rows that ``new`` names by number.

        The numbers travel as bitmaps, one for 32,768 rows, so the staged rows meet them without a shuffle up to some
        hundred million rows, and by one join on the block of rows beyond.
        """
        bits = new.groupBy(F.bitmap_bucket_number("_row").alias("_block")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("_row")).alias("_picked")
        )
        side, _ = broadcast_if_small(bits)
        octet = "cast(conv(hex(substring(_picked, cast(_bit div 8 + 1 as int), 1)), 16, 10) as int)"
        rows = (
            staged.withColumns({"_block": F.bitmap_bucket_number("_row"), "_bit": F.bitmap_bit_position("_row")})
            .join(side, "_block")
            .where(F.expr(f"getbit({octet}, cast(_bit % 8 as int)) = 1"))
            .select(*self.columns, *PARTITION)
        )
        task = F.shiftright("_row", 33)  # of the task that staged the row
        pieces = new.groupBy(task.alias("task"), *PARTITION).agg(F.sum("_bytes").alias("n"))
        n_pieces, n_tasks, n_bytes = pieces.agg(F.count("n"), F.count_distinct("task"), F.sum("n")).first()
        staged_bytes = staged.agg(F.sum("_bytes")).first()[0]
        n_pieces *= max(1, staged_bytes / SPLIT_BYTES / n_tasks)
        if n_bytes < n_pieces * PIECE_BYTES:
            rows = self._gathered(rows)
        split = max(1, folder_bytes(self.spark, path) * SPLIT_BYTES // max(staged_bytes, 1))
        with self._splits_of(split):
            self._laid_out(rows).write.insertInto(self.name)

    @contextmanager
    def _splits_of(self, n_bytes: int):
        """Files are read in splits of at most so many bytes meanwhile."""
        key = "spark.sql.files.maxPartitionBytes"
        before = self.spark.conf.get(key)
        whole = int(self.spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
        self.spark.conf.set(key, str(min(whole, n_bytes)))
        try:
            yield
        finally:
            self.spark.conf.set(key, before)

    def _written(self, rows: DataFrame, path: str) -> DataFrame:
        schema = rows.schema
        rows.write.parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    # Key index: (symbol, id) of every stored row in the table's partitions, sorted by id, so that the bounds of files
    # and row groups tell which of them a batch can have keys in.

    @property
    def keys_name(self) -> str:
        return f"{self.name}_keys"

    def _known_keys(self, fresh: DataFrame, stable_datetime: bool) -> DataFrame:
        """Keys of ``fresh`` that are stored."""
        by = PARTITION if stable_datetime else PARTITION[:1]
        found = fresh.groupBy(*by).agg(F.min("id").alias("low"), F.max("id").alias("high")).collect()  # a row a partition
        inside = F.lit(False)
        for p in found:
            here = F.col("id").between(p["low"], p["high"])
            for column in by:
                here = here & (F.col(column) == p[column])
            inside = inside | here
        self.spark.catalog.refreshTable(self.keys_name)
        stored_keys = self.spark.table(self.keys_name).where(inside).select("symbol", "id")
        keys, _ = broadcast_if_small(fresh.select("symbol", "id"))
        return stored_keys.join(keys, ["symbol", "id"], "left_semi")

    @staticmethod
    def _keys_laid_out(keys: DataFrame) -> DataFrame:
        placed = keys.select("symbol", "id", *PARTITION)
        return placed.hint("rebalance", *PARTITION).sortWithinPartitions(*PARTITION, "id", "symbol")

    def get_property(self, key: str) -> str | None:
        """A value kept with the table."""
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()
        return next((r["value"] for r in rows if r["key"] == key), None)

    def set_property(self, key: str, value: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.name} SET TBLPROPERTIES ('{key}'='{value}')")

    @contextmanager
    def _changing_keys(self):
        """Marks index and summary as behind the table until all are written; whatever fails in between, the mark stays
        and the next insert makes both anew."""
        self.set_property("keys", "behind")
        yield
        self.set_property("keys", "whole")

    def repair_keys(self) -> bool:
        """Make key index and summary from the table where one is missing or behind; whether that was needed."""
        if self.spark.catalog.tableExists(self.keys_name) and self._summary_is_whole():
            return False
        with self._changing_keys():
            for name, columns in ((self.keys_name, "symbol string, id string"), (self.summary_name, SUMMARY)):
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
                self.spark.sql(
                    f"CREATE TABLE {name} ({columns}, symbol_bucket int, month string) "
                    f"USING parquet OPTIONS ('partitionOverwriteMode'='dynamic') PARTITIONED BY ({', '.join(PARTITION)})"
                )
            self._keys_laid_out(self.read()).write.insertInto(self.keys_name)
            self._summary_laid_out(self._partials(self.read())).write.insertInto(self.summary_name)
        return True

    # Summary: count, oldest and newest (time, id) of each symbol and month. Such rows merge, so an insert adds those of
    # its new rows alone, and a delete replaces those of the partitions it changes.

    @property
    def summary_name(self) -> str:
        return f"{self.name}_summary"

    def _summary_is_whole(self) -> bool:
        return self.spark.catalog.tableExists(self.summary_name) and self.get_property("keys") != "behind"

    @staticmethod
    def _partials(rows: DataFrame) -> DataFrame:
        place = F.struct("datetime", "id")
        return rows.groupBy("symbol", *PARTITION).agg(
            F.count(F.lit(1)).alias("n_rows"), F.min(place).alias("oldest"), F.max(place).alias("newest")
        )

    @staticmethod
    def _merged(partials: DataFrame, *by: str) -> DataFrame:
        return partials.groupBy(*by).agg(
            F.sum("n_rows").alias("n_rows"), F.min("oldest").alias("oldest"), F.max("newest").alias("newest")
        )

    @staticmethod
    def _summary_laid_out(partials: DataFrame) -> DataFrame:
        placed = partials.select("symbol", "n_rows", "oldest", "newest", *PARTITION)
        return placed.hint("rebalance", *PARTITION).sortWithinPartitions(*PARTITION, "symbol")

    def _add_to_summary(self, new: DataFrame, work: str) -> None:
        """Merge new rows into the summary of their partitions; one row a symbol and month is left."""
        added = self._written(self._partials(new), f"{work}/added")
        touched = added.select(*PARTITION).distinct().collect()  # a row a partition
        self.spark.catalog.refreshTable(self.summary_name)
        before = self.spark.table(self.summary_name).where(self._in_partitions(touched))
        merged = self._merged(before.unionByName(added), "symbol", *PARTITION)
        self._summary_laid_out(self._written(merged, f"{work}/merged")).write.insertInto(self.summary_name, overwrite=True)

    def summary(self, symbols: list[str] | None = None) -> DataFrame:
        """(symbol, n_rows, oldest, newest) of the stored symbols, the last two as (datetime, id), ties by id.

        Read from the maintained summary; from the table itself while that is missing or behind.
        """
        if self._summary_is_whole():
            self.spark.catalog.refreshTable(self.summary_name)
            partials = self.spark.table(self.summary_name)
        else:
            partials = self._partials(self.read())
        return self._merged(partials if symbols is None else partials.where(self._of_symbols(symbols)), "symbol")

    def delete_where(self, condition: Column, pruning: Column | None = None) -> int:
        """Delete the rows for which ``condition`` is true; returns how many.

        Only partitions holding such rows change. Each kept row of them is written once, to a new folder; the rows there
        are counted, and the delete stops before it changes anything if any is missing. Then each partition is pointed to
        its new folder (or dropped, if it keeps no row), one at a time, so a reader finds it as it was or without the
        deleted rows. Old folders go last: a delete that fails before that leaves a whole table and unused folders.
        """
        rows = self.read() if pruning is None else self.read().where(pruning)
        deleted_rows = F.count_if(F.coalesce(condition, F.lit(False)))
        found = rows.groupBy(*PARTITION).agg(F.count(F.lit(1)).alias("n"), deleted_rows.alias("deleted"))
        touched = found.where(F.col("deleted") > 0).collect()  # a row a partition
        if not touched:
            return 0
        in_touched = self._in_partitions(touched)
        # a partition's rows can lie outside the pruning condition; then they are kept
        keep = self.read().where(in_touched).where(~F.coalesce(condition, F.lit(False)))
        version = f"{self._root()}_versions/{uuid.uuid4().hex[:12]}"
        # rows stay in their partitions, so each task writes those of the files it read, without a shuffle
        laid_out = self._laid_out(keep.select(*self.columns, *PARTITION))
        laid_out.write.option("compression", "zstd").partitionBy(*PARTITION).parquet(version)
        written = self.spark.read.schema(keep.select(*self.columns, *PARTITION).schema).parquet(version)
        counts = {
            (p["symbol_bucket"], p["month"]): p["n"]
            for p in written.groupBy(*PARTITION).agg(F.count(F.lit(1)).alias("n")).collect()
        }
        deleted = sum(p["deleted"] for p in touched)
        whole = self.read().where(in_touched).count() if pruning is not None else sum(p["n"] for p in touched)
        if sum(counts.values()) != whole - deleted:
            raise RuntimeError(
                f"{sum(counts.values())} of {whole - deleted} rows to keep were written to {version}; nothing was deleted"
            )
        with self._changing_keys():
            old = [self._swap(p["symbol_bucket"], p["month"], version, counts) for p in touched]
            self.spark.catalog.refreshTable(self.name)
            self._replace_keys(touched, in_touched)
        for folder in filter(None, old):
            remove_dir(self.spark, folder)
        return deleted

    @staticmethod
    def _in_partitions(partitions: list) -> Column:
        by_month: dict[str, list[int]] = {}
        for p in partitions:
            by_month.setdefault(p["month"], []).append(p["symbol_bucket"])
        inside = F.lit(False)
        for month, buckets in by_month.items():
            inside = inside | ((F.col("month") == month) & F.col("symbol_bucket").isin(*buckets))
        return inside

    def _root(self) -> str:
        return self._detail(f"DESCRIBE TABLE EXTENDED {self.name}")

    def _detail(self, statement: str) -> str:
        """The first folder that a description names: of a partition, where it is one."""
        return next(r["data_type"] for r in self.spark.sql(statement).collect() if r["col_name"] == "Location").rstrip("/")

    def _swap(self, bucket: int, month: str, version: str, counts: dict) -> str | None:
        """Point a partition to its new folder, or drop it with its files; the folder it had before, if that is left."""
        spec = f"PARTITION (symbol_bucket={bucket}, month='{month}')"
        if (bucket, month) not in counts:
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {spec}")
            return None
        before = self._detail(f"DESCRIBE TABLE EXTENDED {self.name} {spec}")
        self.spark.sql(
            f"ALTER TABLE {self.name} {spec} SET LOCATION '{version}/symbol_bucket={bucket}/month={month}'"
        )
        return before

    def _replace_keys(self, touched: list, in_touched: Column) -> None:
        """Index and summary of changed partitions, from their rows."""
        left = self.read().where(in_touched)
        specs = ", ".join(f"PARTITION (symbol_bucket={p['symbol_bucket']}, month='{p['month']}')" for p in touched)
        for name, made in (
            (self.keys_name, self._keys_laid_out(left)),
            (self.summary_name, self._summary_laid_out(self._partials(left))),
        ):
            if self.spark.catalog.tableExists(name):
                self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {specs}")
                made.write.insertInto(name)
                self.spark.catalog.refreshTable(name)

    def drop_symbol(self, symbol: str) -> int:
        """Remove all rows of a symbol."""
        only = self._of_symbols([symbol])
        return self.delete_where(F.col("symbol") == symbol, pruning=only)

    def delete_recent(self, asof: dt.datetime | str, hours: float, symbols: list[str] | None = None) -> int:
        """Delete rows younger than ``hours`` before ``asof``, of all or the given symbols."""
        since = as_ts(asof) - F.lit(dt.timedelta(hours=hours))
        condition = F.col("datetime") > since
        pruning = F.col("month") >= F.date_format(since, "yyyy-MM")
        if symbols is not None:
            condition = condition & F.col("symbol").isin(*symbols)
            pruning = pruning & self._of_symbols(symbols)
        return self.delete_where(condition, pruning)

    def size(self, symbol: str) -> int | None:
        """Stored rows of a symbol, None where there is no table."""
        return self.summary([symbol]).agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0] if self.exists() else None

    def sizes(self, symbols: DataFrame | None = None) -> DataFrame:
        """Stored rows per symbol; with ``symbols`` given, one row each, NULL where nothing is stored."""
        counts = self.summary().select("symbol", "n_rows")
        return counts if symbols is None else symbols.select("symbol").join(counts, "symbol", "left")

    def get_first(self, symbol: str | None = None, order_by: str = "datetime", order: str = "DESC") -> DataFrame:
        """First row by any column, of one symbol (a top-1 scan of its bucket) or of each.

        Of each by time, the summary names the rows, and only the partitions that hold them are read.
        """
        if order not in ("ASC", "DESC"):
            raise ValueError(f"order must be ASC or DESC, not {order!r}")
        if symbol is None and order_by == "datetime":
            return self._named_by_summary("newest" if order == "DESC" else "oldest")
        if symbol is None:
            return get_first(self.read().select(*self.columns), order_by, order, stored=True)
        columns = [F.col(order_by), F.col("id")]
        keys = [c.desc_nulls_last() if order == "DESC" else c.asc_nulls_first() for c in columns]
        return self.read([symbol]).select(*self.columns).orderBy(*keys).limit(1)

    def _named_by_summary(self, which: str) -> DataFrame:
        named = self.summary().select(
            "symbol",
            F.col(which)["id"].alias("id"),
            symbol_bucket(F.col("symbol"), self.n_buckets).alias("symbol_bucket"),
            F.date_format(F.col(which)["datetime"], "yyyy-MM").alias("month"),
        )
        side, _ = broadcast_if_small(named)
        holding = self._in_partitions(side.select(*PARTITION).distinct().collect())  # a row a partition
        return self.read().where(holding).join(side, ["symbol", "id", *PARTITION], "left_semi").select(*self.columns)

    def newest(self, symbol: str | None = None) -> DataFrame:
        return self.get_first(symbol, "datetime", "DESC")

    def oldest(self, symbol: str | None = None) -> DataFrame:
        return self.get_first(symbol, "datetime", "ASC")


def route_by_network(rows: DataFrame, tables: dict[str, PostTable], network: str = "network") -> dict[str, int]:
    """Insert each row into its network's table; an unknown network stops the job before any write.

    The rows are computed once, as they come, and the check is part of that write. A network's insert reads the row groups
    that hold rows of it.
    """
    spark = rows.sparkSession
    work = shared_dir(spark, "routed")
    known = F.col(network).isin(*tables)
    unknown = F.concat(F.lit("unknown network "), F.coalesce(F.col(network), F.lit("NULL")))
    checked = F.when(known, F.col(network)).otherwise(F.raise_error(unknown))
    try:
        stored = rows.withColumn(network, checked).write.option("compression", "zstd")
        stored.option("parquet.block.size", 4 * 1024 * 1024).parquet(work)
        routed = spark.read.schema(rows.schema).parquet(work)
        return {n: t.insert_ignore(routed.where(F.col(network) == n)) for n, t in tables.items()}
    finally:
        remove_dir(spark, work)

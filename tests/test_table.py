"""Stored tables: insert once, delete, prune, route."""

import pytest
from pyspark.sql import functions as F

from postlake.operators import table as table_module
from postlake.operators.table import PostTable, first_versions, route_by_network, scratch_database
from postlake.schemas import COMMENT_FIELDS, REDDIT, TWEET_FIELDS, TWITTER


def rows(spark, values, fields=COMMENT_FIELDS):
    """(symbol, id, datetime, version) rows with every other required column filled."""
    fill = {"string": "x", "int": 1, "boolean": True, "timestamp": "2024-01-01", "date": "2024-01-01"}
    df = spark.createDataFrame(values, "symbol string, id string, day string, version int")
    made = [F.lit(fill[f.type]).cast(f.type).alias(f.name) for f in fields]
    return df.select("symbol", "day", "version", F.col("id").alias("_id"), *made).withColumns(
        {
            "id": F.col("_id"),
            "datetime": F.col("day").cast("timestamp"),
            "update_datetime": F.timestamp_seconds("version"),
        }
    )


def stored(table):
    return sorted((r.symbol, r.id, r.update_datetime.second) for r in table.read().collect())


@pytest.fixture
def table(spark):
    return PostTable(spark, scratch_database(spark), REDDIT, 4)


def test_insert_ignore(spark, table):
    assert table.insert_ignore(rows(spark, [("A", "1", "2024-01-01", 1), ("B", "1", "2024-01-01", 1)])) == 2
    batch = [("A", "1", "2024-02-01", 2), ("A", "2", "2024-02-01", 4), ("A", "2", "2024-02-01", 3)]
    assert table.insert_ignore(rows(spark, batch)) == 1
    assert table.insert_ignore(rows(spark, batch)) == 0
    assert stored(table) == [("A", "1", 1), ("A", "2", 3), ("B", "1", 1)]
    assert table.size("A") == 2 and table.size("none") == 0
    table.drop()
    assert table.size("A") is None


def test_stable_datetime_reads_only_the_batch_months(spark, table):
    table.insert_ignore(rows(spark, [("A", "1", "2024-01-01", 1)]))
    assert table.insert_ignore(rows(spark, [("A", "1", "2024-01-01", 2), ("A", "2", "2024-03-01", 2)]), True) == 1


def test_required_values_and_bucket_count(spark, table):
    with pytest.raises(Exception, match="required value missing: body"):
        table.insert_ignore(rows(spark, [("A", "1", "2024-01-01", 1)]).withColumn("body", F.lit(None).cast("string")))
    with pytest.raises(ValueError, match="buckets"):
        PostTable(spark, table.name.split(".")[0], REDDIT, 5).create()


def test_hot_key_is_reduced_before_the_shuffle(spark, plan_of):
    """A third of the batch is one key; no window gathers it, and partial aggregation precedes the exchange."""
    df = spark.range(3000).select(
        F.lit("A").alias("symbol"),
        F.when(F.col("id") < 1000, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("id"),
        F.timestamp_seconds(F.col("id") % 977 + 1).alias("update_datetime"),
        F.lit("2024-01-01").cast("timestamp").alias("datetime"),
        F.col("id").alias("n"),
    )
    out = first_versions(df)
    plan = plan_of(out)
    assert "Window" not in plan and "partial_min_by" in plan
    assert out.count() == 2001
    first = out.where("id = 'hot'").first()
    assert first.update_datetime.timestamp() == 1 and first.n in (0, 977)


def test_delete_leaves_other_partitions_alone(spark, table):
    values = [(s, f"{d}", f"2024-0{m}-{d:02d}", 1) for s in "ABCDEF" for m in (1, 2) for d in (1, 15, 28)]
    values = [(s, f"{day}", day, v) for s, _, day, v in values]
    table.insert_ignore(rows(spark, values))
    assert table.drop_symbol("A") == 6
    assert table.drop_symbol("A") == 0
    assert {r.symbol for r in table.read().collect()} == set("BCDEF") and table.read().count() == 30
    assert table.delete_recent("2024-02-29", 24 * 15, symbols=["B"]) == 2
    assert table.delete_recent("2024-02-29", 24 * 15) == 8
    assert table.read().where("datetime > timestamp '2024-02-14'").count() == 0
    # every row of February goes: its partitions are emptied and must disappear
    assert table.delete_recent("2024-02-29", 24 * 28 + 1) == 5
    left = table.read()
    assert left.count() == 15 and {r.month for r in left.select("month").distinct().collect()} == {"2024-01"}
    assert not [p for p in spark.sql(f"SHOW PARTITIONS {table.name}").collect() if "2024-02" in p[0]]
    assert table.insert_ignore(rows(spark, values)) == 21


def test_reads_prune_to_the_bucket(spark, table, plan_of):
    table.insert_ignore(rows(spark, [(s, "1", "2024-01-01", 1) for s in "ABCDEFGH"]))
    plan = plan_of(table.newest("A"))
    assert "PartitionFilters: [isnotnull(symbol_bucket" in plan or "symbol_bucket#" in plan.split("PartitionFilters")[1][:200]
    assert "TakeOrderedAndProject" in plan
    assert [r.symbol for r in table.newest("A").collect()] == ["A"]
    assert table.oldest().count() == 8
    assert {r.symbol: r.n_rows for r in table.sizes().collect()}["C"] == 1


def test_routing(spark):
    database = scratch_database(spark)
    tables = {n: PostTable(spark, database, n, 4) for n in (REDDIT, TWITTER)}
    reddit = rows(spark, [("A", "1", "2024-01-01", 1)]).withColumn("network", F.lit(REDDIT))
    twitter = rows(spark, [("A", "1", "2024-01-01", 1)], TWEET_FIELDS).withColumn("network", F.lit(TWITTER))
    both = reddit.unionByName(twitter, allowMissingColumns=True)
    assert route_by_network(both, tables) == {REDDIT: 1, TWITTER: 1}
    with pytest.raises(Exception, match="unknown network other"):
        route_by_network(both.withColumn("network", F.lit("other")), tables)


def test_missing_staged_rows_stop_a_delete(spark, table, monkeypatch):
    table.insert_ignore(rows(spark, [("A", str(i), f"2024-01-{i:02}", i) for i in range(1, 9)]))
    before = stored(table)
    monkeypatch.setattr(PostTable, "_laid_out", staticmethod(lambda df: df.limit(1)))
    with pytest.raises(RuntimeError, match="nothing was deleted"):
        table.delete_recent("2024-01-08", 48)
    assert stored(table) == before


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    from postlake import session

    class Elsewhere:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Elsewhere, "staged")


def test_insert_reads_the_key_index_only_where_the_batch_can_be(spark, table, plan_of):
    """Of many months, one month's keys: no text is read, and only row groups whose ids can be in the batch."""
    for month in range(1, 7):
        values = [(s, f"{month}-{i:03}", f"2024-{month:02}-03", 1) for s in "AB" for i in range(40)]
        assert table.insert_ignore(rows(spark, values)) == 80
    batch = first_versions(table._placed(rows(spark, [(s, f"6-{i:03}", "2024-06-03", 2) for s in "AB" for i in range(50)])))
    for stable in (False, True):
        known = table._known_keys(batch, stable)
        plan = plan_of(known)
        assert known.count() == 80
        assert "body" not in plan and f"{table.network}_keys" in plan
        assert "GreaterThanOrEqual(id,6-000)" in plan and "PartitionFilters: [" in plan
    read = [f for f in known.inputFiles() if "_keys" in f]
    assert all("month=2024-06" in f for f in read)


def test_key_index_follows_inserts_and_deletes(spark, table):
    def keys():
        return sorted(tuple(r) for r in spark.table(table.keys_name).select("symbol", "id").collect())

    def held():
        return sorted((r.symbol, r.id) for r in table.read().collect())

    values = [(s, f"{d}", f"2024-0{m}-{d:02d}", 1) for s in "ABC" for m, d in ((1, 1), (1, 15), (2, 20))]
    table.insert_ignore(rows(spark, values))
    assert keys() == held() and not table.repair_keys()
    table.delete_recent("2024-02-21", 24 * 3)
    assert keys() == held() and len(held()) == 6
    assert table.insert_ignore(rows(spark, values)) == 3
    # a crash between both writes leaves the mark, and the next insert sees what is stored
    bucket = table.read(["A"]).first().symbol_bucket
    spark.sql(f"ALTER TABLE {table.name}_keys DROP PARTITION (symbol_bucket={bucket}, month='2024-01')")
    spark.sql(f"ALTER TABLE {table.name} SET TBLPROPERTIES ('keys'='behind')")
    assert table.insert_ignore(rows(spark, values)) == 0
    assert keys() == held()


def test_summary_follows_inserts_and_deletes(spark, table, plan_of):
    def told():
        return sorted((r.symbol, r.n_rows, *r.oldest, *r.newest) for r in table.summary().collect())

    def counted():
        held: dict[str, list] = {}
        for r in table.read().collect():
            held.setdefault(r.symbol, []).append((r.datetime, r.id))
        return sorted((s, len(v), *min(v), *max(v)) for s, v in held.items())

    def newest():
        return sorted((r.symbol, r.datetime, r.id) for r in table.newest().collect())

    values = [(s, f"{m}{d}{k}", f"2024-0{m}-{d:02d}", 1) for s in "ABC" for m, d in ((1, 1), (1, 15), (2, 20)) for k in "xy"]
    for part in (values[::2], values):
        table.insert_ignore(rows(spark, part))
        assert told() == counted()
    assert spark.table(table.summary_name).count() == 6  # a row a symbol and month, however many inserts
    assert newest() == [(r[0], r[4], r[5]) for r in counted()] and {r[2] for r in newest()} == {"220y"}
    assert {r.id for r in table.oldest().collect()} == {"11x"}
    plan = plan_of(table.summary())
    assert "body" not in plan and f"{table.network}_summary" in plan
    read = [f for f in table.newest().inputFiles() if "/month=" in f]
    assert read and all("month=2024-02" in f for f in read)
    table.delete_recent("2024-02-21", 24 * 3)
    table.drop_symbol("B")
    assert told() == counted() and len(told()) == 2 and table.size("A") == 4 and table.size("B") == 0
    spark.sql(f"ALTER TABLE {table.name} SET TBLPROPERTIES ('keys'='behind')")
    spark.sql(f"TRUNCATE TABLE {table.summary_name}")
    assert told() == counted() and newest() == [(r[0], r[4], r[5]) for r in counted()]  # from the table itself
    table.insert_ignore(rows(spark, values))
    assert told() == counted() and len(told()) == 3
    with pytest.raises(ValueError, match="ASC or DESC"):
        table.get_first(order="up")


@pytest.mark.parametrize("broken", ["_swap", "_replace_keys"])
def test_a_failed_delete_leaves_a_readable_table(spark, table, monkeypatch, broken):
    values = [(s, f"{d}", f"2024-0{m}-{d:02d}", 1) for s in "ABCDEF" for m, d in ((1, 1), (1, 15), (2, 20))]
    table.insert_ignore(rows(spark, values))
    before = stored(table)

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(PostTable, broken, fail)
        with pytest.raises(OSError):
            table.delete_where(F.col("id") == "15")
    left = [r for r in before if broken == "_swap" or r[1] != "15"]
    assert stored(table) == left
    assert table.insert_ignore(rows(spark, values)) == len(before) - len(left)
    assert table.delete_where(F.col("id") == "15") == 6
    assert len(stored(table)) == 12


def test_a_delete_writes_each_kept_row_once(spark, table, monkeypatch):
    table.insert_ignore(rows(spark, [("A", str(i), f"2024-01-{i:02}", i) for i in range(1, 9)]))
    laid = []
    real = PostTable._laid_out
    monkeypatch.setattr(PostTable, "_laid_out", staticmethod(lambda df: laid.append(df.count()) or real(df)))
    assert table.delete_recent("2024-01-08", 48) == 2
    assert laid == [6]


def test_nothing_is_persisted_and_work_folders_go(spark, table):
    kept = set(spark.sparkContext._jsc.getPersistentRDDs().keySet())
    table.insert_ignore(rows(spark, [("A", "1", "2024-01-01", 1)]))
    with pytest.raises(Exception, match="required value"):
        table.insert_ignore(rows(spark, [("A", None, "2024-01-01", 1)]))
    assert set(spark.sparkContext._jsc.getPersistentRDDs().keySet()) == kept


def test_texts_are_not_shuffled(spark, table, monkeypatch, plan_of):
    """Posts under many symbols, each twice: what is written comes straight from the staged files or the table's."""
    laid, real = [], PostTable._laid_out
    monkeypatch.setattr(table_module, "PIECE_BYTES", 0, raising=False)
    monkeypatch.setattr(PostTable, "_laid_out", staticmethod(lambda df: laid.append(plan_of(real(df))) or real(df)))
    values = [(s, f"{d}", f"2024-01-{d:02d}", v) for d in range(1, 9) for s in "ABCDEF" for v in (2, 1)]
    assert table.insert_ignore(rows(spark, values[:24])) == 12
    assert table.insert_ignore(rows(spark, values)) == 36
    assert stored(table) == sorted((s, f"{d}", 1) for d in range(1, 9) for s in "ABCDEF")
    assert table.delete_where(F.col("id") == "3") == 6
    assert len(laid) == 3 and not [p for p in laid if "Exchange hashpartitioning" in p]


@pytest.mark.parametrize("piece", [0, 1 << 40])
def test_new_rows_of_a_long_batch_are_told_by_number(spark, table, monkeypatch, piece):
    """More rows than a bitmap holds, every third key stored before, others given twice."""
    monkeypatch.setattr(table_module, "PIECE_BYTES", piece, raising=False)
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    n = F.col("version")
    base = rows(spark, [("A", "0", "2024-01-01", 1)]).drop("version")
    made = base.crossJoin(spark.range(0, 70_000, 1, 2).withColumnRenamed("id", "version")).select(
        *[c for c in base.columns if c not in ("id", "update_datetime")],
        F.floor(n / 2).cast("string").alias("id"),
        F.timestamp_seconds(n).alias("update_datetime"),
    )
    assert table.insert_ignore(made.where("id % 3 = 0")) == 11_667
    assert table.insert_ignore(made.withColumn("update_datetime", F.col("update_datetime") - F.expr("interval 1 hour"))) == 23_333
    held = table.read().select("id", (F.unix_seconds("update_datetime") - 2 * F.col("id").cast("bigint")).alias("late"))
    assert held.select("id").distinct().count() == held.count() == 35_000
    assert {(r.known, r.late): r["count"] for r in held.groupBy((F.col("id") % 3 == 0).alias("known"), "late").count().collect()} == {
        (True, 0): 11_667, (False, -3600): 23_333
    }
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == split

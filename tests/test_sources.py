import gzip
import json

from postlake.operators.flatten import comment_page_rejects, flatten_comments
from postlake.operators.sizing import broadcast_if_small, spread_scan
from postlake.session import size_shuffles
from postlake.sources.responses import (
    parse_comment_pages,
    read_comment_pages,
    read_tweet_responses,
    stream_comment_pages,
    value_rejects,
)
from postlake.sources.symbols import last_wins, parse_symbol_lines, read_dictionary, read_symbols


def test_symbol_master(spark, tmp_path):
    path = tmp_path / "symbols.csv"
    path.write_text("symbol|shortName|longName\n AAA |First|First Inc\nBBB|Other|\nAAA|Last|Last, Inc.\n")
    rows = read_symbols(spark, str(path))
    assert sorted(r.symbol for r in rows.collect()) == ["AAA", "AAA", "BBB"]
    got = {r.symbol: (r.shortName, r.longName) for r in last_wins(rows).collect()}
    assert got == {"AAA": ("Last", "Last, Inc."), "BBB": ("Other", None)}


def test_last_wins_across_splits_of_one_file(spark, tmp_path):
    lines = ["symbol|shortName|longName"] + [f"S{i % 7}|n{i}|l{i}" for i in range(20000)]
    path = tmp_path / "big.csv"
    path.write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        rows = read_symbols(spark, str(path))
        assert rows.rdd.getNumPartitions() > 3
        got = {r.symbol: r.shortName for r in last_wins(rows).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {f"S{i % 7}": f"n{i}" for i in range(20000 - 7, 20000)}


def test_dictionary(spark, tmp_path):
    path = tmp_path / "words.txt"
    path.write_text("Apple\napple\nÉté\n\nzoo\n")
    assert sorted(r.word for r in read_dictionary(spark, str(path)).collect()) == ["apple", "zoo", "été"]


def test_comment_pages_and_unreadable_records(spark, tmp_path):
    pages = [{"data": [{"id": "a", "body": "x", "created_utc": 5, "score": 1}, {"id": "b"}]}, {"data": []}]
    with gzip.open(tmp_path / "pages.json.gz", "wt") as f:
        f.write("\n".join([json.dumps(p) for p in pages] + ["{broken"]) + "\n")
    read = read_comment_pages(spark, str(tmp_path))
    assert sorted(r.id for r in flatten_comments(read).collect()) == ["a", "b"]
    assert [r.text for r in comment_page_rejects(read).collect()] == ["{broken"]


def test_ids_are_map_keys_not_columns(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"globalObjects": {"tweets": {"77": {"id": 77}}}}) + "\n")
    row = read_tweet_responses(spark, str(tmp_path)).first()
    assert row.globalObjects.tweets["77"].id == 77


def test_broadcast_needs_a_measured_size(spark):
    df = spark.range(100).selectExpr("id", "repeat('x', 100) AS s")
    assert broadcast_if_small(df)[1]
    assert not broadcast_if_small(df, max_rows=99)[1]
    assert not broadcast_if_small(df, max_bytes=1000)[1]


def test_spread_scan(spark, tmp_path):
    spark.range(50).coalesce(1).write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    assert spread_scan(df).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 100, 1, 16)
    assert spread_scan(many) is many


def test_shuffles_are_sized(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, 10 * 2**40) == 10 * 2**40 // 2**28
        assert size_shuffles(spark, 1) == spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_symbol_columns_by_name_and_doubled_quotes(spark, tmp_path):
    path = tmp_path / "named.csv"
    path.write_text('longName|exchange|symbol|shortName\n"Foo ""Bar"" Inc"|NYSE|AAA|Foo\n')
    row = read_symbols(spark, str(path)).first()
    assert (row.symbol, row.shortName, row.longName) == ("AAA", "Foo", 'Foo "Bar" Inc')


def test_both_symbol_readers_take_doubled_quotes(spark, tmp_path):
    line = 'AAA|Foo|"Foo ""Bar"" Inc"'
    (tmp_path / "one.csv").write_text(f"symbol|shortName|longName\n{line}\n")
    held = parse_symbol_lines(spark.createDataFrame([(line, 0)], "value string, file_pos long"))
    names = [tuple(df.select("symbol", "shortName", "longName").first()) for df in (held, read_symbols(spark, str(tmp_path)))]
    assert names == [("AAA", "Foo", 'Foo "Bar" Inc')] * 2


EPOCHS = [1600000000, 1600000000.0, "1600000000", "1.6e9", 1600000000.9, "soon", None, True, 2**70]


def test_numbers_in_any_form_and_paths_of_wrong_values(spark, tmp_path):
    page = {"data": [{"id": str(i), "created_utc": e, "score": 1} for i, e in enumerate(EPOCHS)]}
    texts = [json.dumps(page), json.dumps({"data": [{"id": "x", "created_utc": 2.0}]}), json.dumps({"data": 7}), "{broken"]
    (tmp_path / "p.json").write_text("\n".join(texts) + "\n")
    held = parse_comment_pages(spark.createDataFrame([(t,) for t in texts], "value string"))
    for pages in (read_comment_pages(spark, str(tmp_path)), held):
        got = {r.id: (r.created_utc, r.score) for r in flatten_comments(pages).collect()}
        want = {str(i): (1600000000 if i < 5 else None, 1) for i in range(len(EPOCHS))}
        assert got == want | {"x": (2, None)}
        wrong = sorted(map(tuple, value_rejects(pages).collect()))
        assert wrong == [("data.5.created_utc", "soon"), ("data.7.created_utc", "true"), ("data.8.created_utc", str(2**70))]
        rejects = {r.text: r.reject_reason for r in comment_page_rejects(pages).collect()}
        assert rejects == {texts[0]: "value_of_wrong_type", texts[2]: "unreadable_json", texts[3]: "unreadable_json"}


def test_wrong_values_of_a_stream_of_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "p.json").write_text(json.dumps({"data": [{"id": "a", "score": "7.0"}, {"id": "b", "score": "x"}]}) + "\n")
    rows = flatten_comments(stream_comment_pages(spark, str(tmp_path / "in"))).select("id", "score")
    query = rows.writeStream.format("memory").queryName("typed_pages").option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(map(tuple, spark.table("typed_pages").collect())) == [("a", 7), ("b", None)]

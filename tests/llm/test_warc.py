import hashlib

from postlake.llm import warc as q

LONG = "x" * 200
PAGES = [
    (3, "a", LONG), (3, "a", LONG), (None, None, LONG), (None, "u\r\nX: y", LONG), (7, "e", LONG), (4, "b", None), (5, "c", ""),
    (6, "d", "é" * 100 + "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"), (8, "f", "é" * 49), (9, "g", "é" * 49), (10, "h", "é" * 50),
    (11, "h", "é" * 50), (12, "i", "line\n" * 50_000),
]


def test_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    q.write_archives(pages, f"{tmp_path}/warc", archive_bytes=600)
    rows = q.read_archives(spark, f"{tmp_path}/warc").collect()
    first = {}
    for page, _, html in sorted((p for p in PAGES if p[0] is not None), key=lambda p: p[0]):
        first.setdefault(html, page)
    want = []
    for page, _, html in PAGES:
        data = (html or "").encode()
        original = first.get(html) if len(data) >= 100 else None
        again = original is not None and page != original
        want.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", original if again else None))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert all(r.told_digest == r.payload_digest for r in rows)


def test_all_ids_null_are_responses(spark, tmp_path):
    pages = spark.createDataFrame([(None, "a", LONG), (None, "b", LONG)], "page_id long, url string, html string")
    q.write_archives(pages, f"{tmp_path}/warc")
    assert {r.record_type for r in q.read_archives(spark, f"{tmp_path}/warc").collect()} == {"response"}


def test_query_and_empty_tables(spark, small_dir, empty_dir):
    rows = {r.page_id: r for r in q.op10_warc(spark, small_dir).collect()}
    assert (rows[2].record_type, rows[2].refers_to, rows[3].payload_bytes) == ("revisit", 1, 0)
    assert q.op10_warc(spark, empty_dir).count() == 0

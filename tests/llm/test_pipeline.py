import corpus_pipeline
from postlake.llm.queries import ORACLES, QUERIES


def test_stages_run_in_turn(spark, small_dir, awkward):
    out = corpus_pipeline.run(spark, small_dir)
    assert out.columns[: len(awkward.columns)] == awkward.columns
    ids = {r.doc_id for r in out.collect()}
    assert 0 in ids and not ids & {20, 21, 30, 31, 33, 41, 43}  # copies and texts that the rules reject


def test_empty_tables(spark, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).count() == 0


def test_registered():
    import __spark_entry__ as entry

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontaminate", "pii", "mix_sources"]
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())

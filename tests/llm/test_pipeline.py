"""The whole pipeline against a plain-Python version of what its stages decide."""

import pytest
from pyspark.sql import functions as F
from helpers import docs, prose

import corpus_pipeline
from loanlens.llm.common import shared_table

EN = ["river", "stone", "window", "garden", "market", "winter", "letter", "candle", "bridge", "silver", "forest", "morning"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    items = [(i, prose(700 + i, 30, EN) + ". " + prose(800 + i, 6, EN) + ".") for i in range(8)]
    rows = [(i, "\n".join(prose(10 * i + k, 25, EN) for k in range(4)), "en", f"src{i % 3}") for i in range(90)]
    rows = [(i, "Site menu home about contact\n" + t if s == "src0" else t, g, s) for i, t, g, s in rows]
    rows += [(200 + i, rows[5][1], "en", "src1") for i in range(6)]                                     # exact copies
    rows += [(300 + i, rows[7][1] + "\n" + it[1], "en", "src2") for i, it in enumerate(items[:4])]     # leaks
    rows += [(400, None, "en", "src1"), (401, "12 34 !!", "en", "src1"), (None, prose(9999, 80, EN), None, None), (3, rows[3][1], "en", "src0")]
    docs(spark, rows).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontaminate", "mix"]


def test_run(spark, folder):
    got = corpus_pipeline.run(spark, folder).collect()
    ids = sorted((r["doc_id"] for r in got if r["doc_id"] is not None))
    # the copies are a sixth of the pages of their source, so line dedup takes all their lines; of the empty texts one stays
    assert ids == [*range(90), 200] and sum(r["doc_id"] is None for r in got) == 1
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    size = {r["doc_id"]: r["size"] for r in got}
    assert size[200] == 0 and all(size[i] == 100 for i in range(90))                   # the menu line is gone, everything else is there


def test_stages_keep_columns_and_empty_tables(spark, folder):
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    for table in (frame, frame.limit(0)):
        at = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            at = shared_table(stage(spark, at, folder), f"test-{name}")
            assert at.columns == frame.columns
        assert corpus_pipeline.STAGES[-1][1](spark, at, folder).columns == ["doc_id", "size", "source_size", "target", "taken"]


def test_stages_on_very_long_texts_and_clashing_names(spark, folder):
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    long = prose(4242, 60_000, EN)
    item = spark.read.parquet(f"{folder}/benchmark.parquet").filter("item_id = 6").first()["text"]
    more = docs(spark, [(5000, long, "en", "src0"), (5001, long, "en", "src1"), (5002, long[::-1] + "\n" + item, "en", "src2")])
    odd = frame.unionByName(more).withColumnsRenamed({"n_chars": "__matches"}).withColumns(
        {c: F.lit(c) for c in ("__rejected", "__host", "__fp", "row", "keys", "rejected", "lang_pred", "c0")})
    at = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = shared_table(stage(spark, at, folder), f"test-odd-{name}")
        assert at.columns == odd.columns
        assert at.filter("`__rejected` <> '__rejected' or keys <> 'keys' or row <> 'row'").count() == 0
    ids = {r["doc_id"] for r in at.select("doc_id").collect()}
    assert 5000 in ids and not ids & {5001, 5002}                       # a copy and a leak, both very long
    assert {r["doc_id"]: r["size"] for r in corpus_pipeline.STAGES[-1][1](spark, at, folder).collect()}[5000] == 60_000

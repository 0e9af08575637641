"""The corpus pipeline: every stage on odd rows, and the chain against its stages' own operators."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from folioforge.llm import bpe_fst

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"long{i}" for i in range(20_000))
ROWS = [(1, None, "en"), (2, "", None), (None, "a plain text of a few words here", "en"), (None, None, None), (4, "one line\nand two\nand three\nand four", "en"), (5, "x\none line\nand two\nand three\ny", "en"), (6, LONG, "de"), (6, LONG + " end", "de"), (7, "nothing like any of the others at all, so it stays", "fr")]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string").withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("long"))
    for c in ("score", "digest", "fp", "maybe"):  # names that stages work with
        df = df.withColumn(c, F.lit("clash"))
    return df


def texts(df):
    return sorted((r.text for r in df.select("text").collect()), key=str)


def test_stages_on_odd_rows(spark, docs):
    want = {
        "toxicity": sorted((t for _, t, _ in ROWS), key=str),
        "line_dedup": sorted((t if i != 5 else "x\ny" for i, t, _ in ROWS), key=str),
        "decontamination": sorted((t for _, t, _ in ROWS), key=str),
    }
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and stage(spark, docs.limit(0), SF).count() == 0
        if name in want:
            assert texts(out) == want[name], name
    kept = corpus_pipeline.simhash_stage(spark, docs, SF).collect()
    assert len(kept) == 6 and sum(not r.text for r in kept) == 1 and sum((r.text or "").startswith("long0") for r in kept) == 1
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert out.count() == len(ROWS) and out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_decontamination_takes_effect(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    docs = spark.createDataFrame([(1, "before " + item + " after"), (2, "clean"), (2, item)], "doc_id long, text string")
    assert [r.text for r in corpus_pipeline.decontamination_stage(spark, docs, SF).collect()] == ["clean"]


def test_chain(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    source = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert 0 < len(rows) < len(source) and {r.doc_id for r in rows} <= set(source)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
    want = bpe_fst.digest(docs, bpe_fst.rank_file()).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, want))

"""Empty tables and odd rows through every operator and pipeline stage."""

import pytest

import corpus_pipeline
from weathermart.llm import decontaminate, jaccard, line_rules, mixing, passages, pseudonyms, secrets, sharding
from weathermart.llm.queries import tokenizer_path
from weathermart.llm import token_records
from pyspark.sql import functions as F

RUNS = {
    "op1": lambda d, b: token_records.encode_documents(d, tokenizer_path()),
    "op2": lambda d, b: sharding.shard_documents(d),
    "op3": lambda d, b: mixing.mix(d, F.array("source"))[0],
    "op4": decontaminate.contaminated,
    "op5": lambda d, b: line_rules.line_rules(d),
    "op6": lambda d, b: secrets.find_secrets(d),
    "op8": lambda d, b: pseudonyms.pseudonymise(d, b"key"),
    "op9": lambda d, b: passages.repeated_passages(d),
    "op10": lambda d, b: jaccard.similar_documents(d),
}
FREE = {"op4", "op9"}  # rows for what is found only


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(0, None), (1, ""), (2, "few words")], "item_id long, text string")


@pytest.mark.parametrize("name", sorted(RUNS))
def test_empty_tables_give_no_rows(no_docs, benchmark, name):
    assert RUNS[name](no_docs, benchmark).count() == 0


@pytest.mark.parametrize("name", sorted(RUNS))
def test_odd_rows_all_come_back(odd_docs, benchmark, name):
    n = RUNS[name](odd_docs, benchmark).count()
    assert name in FREE or n == odd_docs.count()


@pytest.fixture(scope="module")
def small_dir(spark, tmp_path_factory, benchmark):
    folder = tmp_path_factory.mktemp("tables")
    benchmark.write.parquet((folder / "benchmark.parquet").as_uri())
    return folder.as_uri()


@pytest.mark.parametrize("kind", ["odd_docs", "no_docs"])
def test_stages_take_odd_and_empty_documents(spark, small_dir, request, kind):
    docs = request.getfixturevalue(kind)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small_dir)
        assert docs.columns == request.getfixturevalue(kind).columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, small_dir).count() == docs.count()

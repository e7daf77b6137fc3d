"""The registered queries against their SQL, and the pipeline against its stages one by one."""

import duckdb
import pytest

import check
import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from pagesieve.llm import bpe, decontaminate, near_dup
from pagesieve.llm.oracles import ORACLES
from pagesieve.llm.queries import PATTERN, QUERIES, RANKS
from tests.llm.test_similar import linked_by_hand
from tests.llm.test_text_scans import words_by_hand

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in check.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_registered():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert {*QUERIES, "pipeline"} <= set(queries())
    assert set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", [*QUERIES])
def test_query(spark, db, name):
    outcome, _ = check.compare(spark, db, name, FOLDER)
    assert outcome.startswith("same") if name in ORACLES else outcome.endswith("no SQL"), outcome


def test_pipeline(spark):
    folder = "/root/testdata/sf0.01"
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "quality_classifier", "near_dedup", "benchmark_decontamination", "byte_level_bpe"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        steps.append(spark.createDataFrame(stage(spark, steps[-1], folder).collect(), docs.schema))
        assert steps[-1].columns == docs.columns
    texts = [{row.doc_id: row.text for row in step.collect()} for step in steps]
    assert all(set(after) <= set(before) for before, after in zip(texts, texts[1:], strict=False))
    assert len(texts[1]) >= 0.97 * len(texts[0])
    marks = {row.doc_id: row.quality for row in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    gone = [marks[key] for key in texts[1] if key not in texts[2] and key in marks]
    assert gone.count(0) >= 0.9 * list(marks[key] for key in texts[1] if key in marks).count(0) and gone.count(1) <= 3
    _, component = linked_by_hand(texts[2], near_dup.Likeness().shingle, near_dup.Likeness().percent)
    assert set(texts[3]) == set(component.values())
    lines = lambda text, n: {tuple(words[at : at + n]) for words in [words_by_hand(text)] for at in range(len(words) - n + 1)}
    windows = {}
    for row in spark.read.parquet(f"{folder}/benchmark.parquet").collect():
        size = min(10, len(words_by_hand(row.text)))
        windows.setdefault(size, set()).update(lines(row.text, size))
    hit = lambda text: any(lines(text, size) & known for size, known in windows.items())
    assert set(texts[4]) == {key for key, text in texts[3].items() if not hit(text)}
    assert len(texts[4]) < len(texts[3])
    codec = bpe.Codec(bpe.read_ranks(RANKS), PATTERN)
    result = corpus_pipeline.run(spark, folder)
    assert result.columns == ["doc_id", "lang", "source", "n_chars", "n_tokens", "ids"]
    assert {row.doc_id: (row.n_tokens, bytes(row.ids)) for row in result.collect()} == {
        key: (len(ids), ids.astype("<u4").tobytes()) for key, ids in ((key, codec.encode(text)) for key, text in texts[4].items())
    }
    assert decontaminate.WINDOW == 10


def test_stages_take_empty_tables_and_more_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumnRenamed("n_chars", "score").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        assert out.count() == 0 and (name == "byte_level_bpe" or out.columns == docs.columns)


def test_stages_take_nulls(spark):
    rows = [(None, None, None, None, None), (1, None, "en", None, None), (2, "", None, "s", 0), (3, "The light of the house is over the river.", "en", "s", 40)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).collect()

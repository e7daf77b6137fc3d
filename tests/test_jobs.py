import datetime
import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesieve.operators.clean import Cleaning, dictionary_splitter
from pagesieve.operators.features import page_features
from pagesieve.plans import maintenance, scoring, training
from pagesieve.schemas import RESULT
from pagesieve.session import new_folder
from pagesieve.sources import marks, results
from pagesieve.sources.params import TrainingParams
from pagesieve.streaming.batch import counted, run_above_mark
from pagesieve.streaming.incremental import handle_batch, run_incremental, stream_rows

ROWS = "offset long, website_name string, domain string, url string, file_path string, x double"


def now():
    return F.lit("2024-01-31 12:00:00").cast("timestamp_ntz")


def page(offset, x):
    return (offset, f"site{offset}", "www.a.com.cn", f"http://a/{offset}", f"d/{offset}.html", x)


def job(rows):
    found = scoring.cascade(rows, scoring.linear_scorer({"x": 1.0}, 0.0))
    return scoring.result_rows(found, "root", now())


# -- scoring


def test_batch_scorer_loads_once_per_task(spark, tmp_path):
    log = tmp_path / "loads"

    def load():
        with open(log, "a") as out:
            out.write("x\n")
        return lambda batch: np.column_stack([1 - batch["x"], batch["x"]])

    df = spark.range(40, numPartitions=2).withColumn("x", F.col("id") / 40)
    df = df.withColumn("kept", F.concat(F.lit("r"), "id"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 5)
    try:
        found = scoring.batch_scorer(load, ["x"])(df).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2000)
    assert len(log.read_text().split()) == 2
    for row in found:
        assert row["kept"] == f"r{row['id']}"
        assert row["probabilities"] == pytest.approx([1 - row["x"], row["x"]])
        assert row["classes"] == int(row["x"] > 0.5)


def test_cascade(spark):
    df = spark.createDataFrame([(at, at / 10 - 0.5, (at % 3) - 1.0) for at in range(11)], "id int, x double, y double")
    main, sub = scoring.linear_scorer({"x": 1.0}, 0.0), scoring.linear_scorer({"y": 1.0}, 0.0)
    first = {row["id"]: row["logits"] for row in scoring.cascade(df, main).collect()}
    both = scoring.cascade(df, main, sub)
    assert both.columns == ["id", "x", "y", "logits_main", "logits_sub"]
    found = {row["id"]: (row["logits_main"], row["logits_sub"]) for row in both.collect()}
    assert set(first) == {6, 7, 8, 9, 10}
    assert set(found) == {8}
    assert found[8][0] == first[8] > 0.5 < found[8][1]


def test_result_rows(spark):
    row = job(spark.createDataFrame([page(1, 2.0), page(2, -2.0)], ROWS)).collect()
    assert len(row) == 1
    assert row[0].asDict() == {
        "offset": 1,
        "wzmc": "site1",
        "ym": "www.a.com.cn",
        "yjym": "a.com.cn",
        "url": "http://a/1",
        "nwdz": "root/2024-01-31/1.html",
        "rksj": datetime.datetime(2024, 1, 31, 12),
        "logits": pytest.approx(0.880797, abs=1e-6),
    }


def test_whole_job_on_han_pages(spark):
    """Two models over rows and separate snapshots; a row whose snapshot is missing is scored too."""
    dictionary = spark.createDataFrame([("网贷", 9), ("理财", 9), ("新闻", 9), ("首页", 9)], "word string, freq long")
    rows = spark.createDataFrame([page(at, 0.0) for at in (1, 2, 3, 4)], ROWS).drop("x")
    rows = rows.withColumn("file_path", F.concat(F.lit("/"), "file_path"))
    meta = '<meta name="keywords" content="{}"><meta name="description" content="{}">'
    pages = [
        ("d/1.html", f"<title>网贷</title>{meta.format('理财', '首页')}<p>网贷理财首页</p>"),
        ("d/2.html", "<title>新闻</title><p>新闻首页</p>"),
        ("d/3.html", "<title>网贷</title><p>网贷新闻</p>"),
        ("d/9.html", "<p>网贷</p>"),
    ]
    snapshots = spark.createDataFrame(pages, "file_path string, html string")
    stop = spark.createDataFrame([("首页",)], "word string")
    seen = []

    def has(word, column):
        def score(df):
            seen.append(column)
            flag = F.when(F.array_contains(column, word), 1.0).otherwise(-1.0)
            return scoring.linear_scorer({"flag": 1.0}, 0.0)(df.withColumn("flag", flag)).drop("flag")

        return score

    known = spark.createDataFrame([("网贷", 2, 9)], "word string, df long, n_docs long")
    how = Cleaning(dictionary_splitter(dictionary))
    args = (rows, snapshots, how, stop)
    main, sub = has("网贷", "tag_words"), has("理财", "meta_words")
    for every in (False, True):
        one = scoring.score_pages(*args, main, frequencies=known, all_snapshots=every)
        assert sorted(row["offset"] for row in one.collect()) == [1, 3]
        two = scoring.score_pages(*args, main, sub, frequencies=known, all_snapshots=every).collect()
        assert [row["offset"] for row in two] == [1]
        assert two[0]["meta_words"] == ["网贷", "理财"]
        assert two[0]["file_path"] == "d/1.html"


def test_archiving_job_repeated(spark, tmp_path):
    """Copies come before the stored rows; a second handling of the batch changes nothing."""
    for name in ("1", "2"):
        (tmp_path / "store" / "d").mkdir(parents=True, exist_ok=True)
        (tmp_path / "store" / "d" / f"{name}.html").write_text(name)
    rows = spark.createDataFrame([page(1, 2.0), page(2, -2.0), page(3, 2.0)], ROWS)
    archive_job = scoring.archiving(
        lambda df: scoring.cascade(df, scoring.linear_scorer({"x": 1.0}, 0.0)),
        str(tmp_path / "store"), str(tmp_path / "kept"), "root", now(),
    )
    result, saved = str(tmp_path / "result"), str(tmp_path / "marks")
    for _ in range(2):
        handle_batch(rows, 0, archive_job, result, saved)
    stored = results.read_result(spark, result, RESULT).collect()
    assert sorted(row["nwdz"] for row in stored) == ["root/2024-01-31/1.html", "root/2024-01-31/3.html"]
    assert [path.name for path in (tmp_path / "kept").rglob("*.html")] == ["1.html"]


def test_training(spark):
    rows = []
    for at in range(40):
        good = at % 2
        rows.append((at, ["网贷", "理财"] if good else ["新闻", "体育"], ["平台"] if good else [], good))
    df = spark.createDataFrame(rows, "id int, tag_words array<string>, meta_words array<string>, label int")
    params = TrainingParams(l2_reg_lambda=0.01, num_epochs=10, num_features=256)
    path = new_folder(spark, "model")
    training.save_model(training.train(df, params), path)
    score = scoring.pipeline_scorer(training.load_model(path))
    found = score(df)
    assert found.columns == [*df.columns, "probabilities", "classes"]
    assert found.where("classes = label").count() == 40
    record = spark.createDataFrame([(1, ["理财", "网贷", "散标"], ["平台"], 1)], df.schema)
    row = scoring.decode(score(record)).first()
    assert row["classes"] == 1 and row["probability"] > 0.5


def test_training_with_vectors(spark):
    from pyspark.ml.functions import array_to_vector

    rows = [(["a"], ["b"], [float(at % 2), 1.0], at % 2) for at in range(20)]
    df = spark.createDataFrame(rows, "tag_words array<string>, meta_words array<string>, v array<double>, label int")
    df = df.withColumn("v", array_to_vector("v"))
    model = training.train(df, TrainingParams([1], 0.01, 10, 64), ("v",))
    assert scoring.pipeline_scorer(model)(df).where("classes = label").count() == 20


def test_filters_do_not_repeat_python(spark):
    model = scoring.batch_scorer(lambda: lambda batch: np.zeros((len(batch), 2)), ["x"])
    df = page_features(spark.createDataFrame([("<p>", 1.0)], "html string, x double"))
    plan = scoring.cascade(df, model, model).where("title is not null")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("ArrowEvalPython") == 3


def test_filters_on_keys_reach_the_scan(spark, tmp_path):
    rows = spark.createDataFrame([(1, "<title>a</title>"), (2, "<title>b</title>")], "page_id long, html string")
    rows.write.parquet(str(tmp_path / "pages"))
    df = page_features(spark.read.parquet(str(tmp_path / "pages"))).where("page_id > 1")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(page_id,1)" in plan and plan.count("ArrowEvalPython") == 1
    assert [row["title"] for row in df.collect()] == ["b"]


def test_scored_sample(spark, tmp_path):
    rows = [(at, "网贷", "", "", "理财", "trainset" if at else "testset") for at in range(4)]
    names = ("title", "keywords", "description", "corpus", "class")
    table = spark.createDataFrame(rows, "id long, " + ", ".join(f"{name} string" for name in names))
    dictionary = spark.createDataFrame([("网贷", 9)], "word string, freq long")
    how, stop = Cleaning(dictionary_splitter(dictionary)), spark.createDataFrame([("首页",)], "word string")
    model = scoring.linear_scorer({"id": 1.0}, -1.5)
    scoring.score_sample(table, "trainset", "id", how, stop, model, str(tmp_path / "scores"), 2)
    back = spark.read.csv(str(tmp_path / "scores"), header=True, inferSchema=True).orderBy("id").collect()
    assert [(row["id"], row["classes"]) for row in back] == [(1, 0), (2, 1)]


# -- incremental


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    source, result, saved, checkpoint = (str(tmp_path / name) for name in ("in", "out", "marks", "cp"))
    first = spark.createDataFrame([page(at, (-1.0) ** at) for at in range(1, 9)], ROWS)
    late = spark.createDataFrame([page(20, 1.0), page(3, 1.0)], ROWS)
    first.repartition(3).write.parquet(source)

    def run():
        run_incremental(stream_rows(spark, source, first.schema, 1), job, result, saved, checkpoint)
        return results.read_result(spark, result, RESULT)

    key = lambda row: row["offset"]
    assert sorted(run().collect(), key=key) == sorted(job(first).collect(), key=key)
    assert marks.read_mark(spark, saved) == 8
    run()
    assert run().count() == 4
    late.coalesce(1).write.mode("append").parquet(source)
    assert sorted(row["offset"] for row in run().collect()) == [2, 3, 4, 6, 8, 20]
    assert marks.read_mark(spark, saved) == 20


def test_a_batch_handled_twice_counts_once(spark, tmp_path):
    result, saved = str(tmp_path / "out"), str(tmp_path / "marks")
    rows = spark.createDataFrame([page(1, 1.0), page(2, 1.0)], ROWS)
    for _ in range(2):
        handle_batch(rows, 5, job, result, saved)
    assert results.read_result(spark, result, RESULT).count() == 2
    withbatch = T.StructType([*RESULT.fields, T.StructField("batch_id", T.StringType())])
    assert {row["batch_id"] for row in results.read_result(spark, result, withbatch).collect()} == {"stream-5"}


def test_queries_with_own_checkpoints_share_a_result(spark, tmp_path):
    result, saved = str(tmp_path / "out"), str(tmp_path / "marks")
    for name, ids in (("a", range(1, 7)), ("b", range(7, 9))):
        rows = spark.createDataFrame([page(at, 1.0) for at in ids], ROWS)
        rows.repartition(2).write.parquet(str(tmp_path / name))
        stream = stream_rows(spark, str(tmp_path / name), rows.schema, 1)
        run_incremental(stream, job, result, saved, str(tmp_path / f"{name}-checkpoint"))
    assert sorted(row["offset"] for row in results.read_result(spark, result, RESULT).collect()) == list(range(1, 9))


def table_of(spark, *ids):
    rows = [(at, "s", "d.com", "u", f"f{at}", 1.0) for at in ids]
    return spark.createDataFrame(rows, "id long, sname string, domain string, url string, snapshot string, x double")


def test_runs_after_a_reset_lose_nothing(spark, tmp_path):
    result, saved = str(tmp_path / "out"), str(tmp_path / "marks")
    assert run_above_mark(table_of(spark, 1, 2, 3), job, result, saved) == 3
    marks.reset_mark(spark, saved)
    assert run_above_mark(table_of(spark, 4), job, result, saved) == 1
    assert sorted(row["offset"] for row in results.read_result(spark, result, RESULT).collect()) == [1, 2, 3, 4]


def test_a_broken_run_is_repeated_as_it_was(spark, tmp_path):
    result, saved = str(tmp_path / "out"), str(tmp_path / "marks")

    def broken(rows):
        results.write_batch(job(rows), result, "table-0")
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        run_above_mark(table_of(spark, 1, 2), broken, result, saved)
    assert run_above_mark(table_of(spark, 1, 2, 3), job, result, saved) == 2
    assert run_above_mark(table_of(spark, 1, 2, 3), job, result, saved) == 1
    assert sorted(row["offset"] for row in results.read_result(spark, result, RESULT).collect()) == [1, 2, 3]
    assert marks.read_mark(spark, saved) == 3


def test_mark_moves_without_positives(spark, tmp_path):
    result, saved = str(tmp_path / "out"), str(tmp_path / "marks")
    handle_batch(spark.createDataFrame([page(4, -1.0)], ROWS), 0, job, result, saved)
    handle_batch(spark.createDataFrame([], ROWS), 1, job, result, saved)
    assert marks.read_mark(spark, saved) == 4
    assert results.read_result(spark, result, RESULT).count() == 0


def test_table_job(spark, tmp_path):
    result, saved = str(tmp_path / "out"), str(tmp_path / "marks")

    def table(*ids):
        rows = [(at, "s", "d.com", "u", None if at == 4 else f"f{at}", 1.0) for at in ids]
        return spark.createDataFrame(rows, "id long, sname string, domain string, url string, snapshot string, x double")

    marks.write_mark(spark, saved, 2)
    assert run_above_mark(table(1, 2, 3, 4, 5), job, result, saved) == 2
    assert marks.read_mark(spark, saved) == 5
    assert run_above_mark(table(1, 2, 3, 4, 5), job, result, saved) == 0
    assert run_above_mark(table(1, 2, 3, 4, 5, 6), job, result, saved) == 1
    found = results.read_result(spark, result, RESULT).collect()
    assert sorted(row["offset"] for row in found) == [3, 5, 6]


def test_counting_while_passing(spark):
    df, observed = counted(spark.range(9), "nine")
    df.write.format("noop").mode("overwrite").save()
    assert observed.get["n_rows"] == 9


# -- upkeep


def test_upkeep(spark):
    folder, day = new_folder(spark, "tables"), datetime.date(2024, 1, 31)
    table, saved = f"t_{folder[-32:]}", f"{folder}/marks"
    maintenance.save_table(spark.range(10).withColumnRenamed("id", "offset"), table, folder)
    marks.write_mark(spark, saved, 6)
    copy = maintenance.maintain(spark, table, saved, 6, day, folder)
    assert copy == f"{table}_2024_01_31_bak"
    assert spark.table(copy).count() == 10
    assert sorted(row["offset"] for row in spark.table(table).collect()) == [6, 7, 8, 9]
    assert marks.read_mark(spark, saved) == 0
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        maintenance.backup_table(spark, table, day, folder)
    maintenance.purge_table(spark, table, 8, folder)
    assert sorted(row["offset"] for row in spark.table(table).collect()) == [8, 9]
    # Only the table as it is now and its backup have files left.
    place = folder.split(":", 1)[-1]
    assert sum(name.startswith("t_") for name in os.listdir(place)) == 2
    assert spark.table(copy).count() == 10


def test_csv_scores(spark, tmp_path):
    scores = spark.createDataFrame([(1, 0.25, 1), (2, 0.1 + 0.2, 0)], "id long, probability double, classes int")
    results.write_scores_csv(scores, str(tmp_path / "scores"))
    back = results.read_scores_csv(spark, str(tmp_path / "scores"), scores.schema)
    assert sorted(back.collect()) == sorted(scores.collect())


def test_fitted_model_scores_after_an_observation(spark):
    # An observation makes the session hold a manager that cannot be sent to tasks.
    df, observed = counted(spark.range(3), "three")
    df.write.format("noop").mode("overwrite").save()
    assert observed.get["n_rows"] == 3
    rows = spark.createDataFrame(
        [([f"w{i % 3}", "x"], [f"m{i % 2}"], i % 2) for i in range(12)],
        "tag_words array<string>, meta_words array<string>, label int",
    )
    model = training.train(rows, TrainingParams([1], 0.01, 3, 1 << 8))
    scored = scoring.pipeline_scorer(model)(rows).collect()
    assert len(scored) == 12 and all(abs(sum(row["probabilities"]) - 1.0) < 1e-9 for row in scored)


def test_network_on_vectors_learns_and_reloads(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(400):
        x = rng.normal(size=6)
        rows.append(([float(v) for v in x], [float(x[0] * x[1])] if i % 7 else None, int(x[0] + 0.5 * x[2] > 0)))
    df = spark.createDataFrame(rows, "pooled array<double>, extra array<double>, label int")
    inputs = {"pooled": 6, "extra": 1}
    model = training.train_vectors(df, inputs, hidden=8, epochs=60)
    scored = scoring.pipeline_scorer(model)(training.with_vectors(df, inputs)).collect()
    accuracy = sum(row["classes"] == row["label"] for row in scored) / len(scored)
    assert accuracy > 0.9


def test_batch_counts_in_one_pass(spark):
    folder = new_folder(spark, "counts")
    result, saved = f"{folder}/result", f"{folder}/marks"
    reads = spark.sparkContext.accumulator(0)

    def seen(x):
        reads.add(1)
        return x

    from pyspark.sql.functions import udf

    touch = udf(seen, "double")
    rows = spark.createDataFrame([page(1, 2.0), page(2, -3.0), page(3, 5.0)], ROWS).withColumn("x", touch("x"))
    handle_batch(rows, 0, job, result, saved)
    handle_batch(spark.createDataFrame([], ROWS), 1, job, result, saved)
    handle_batch(rows, 0, job, result, saved)  # repeated: replaces its counts
    assert reads.value == 6  # two runs of three rows, no pass of its own for the offset
    from pagesieve.streaming.incremental import read_counts

    counts = sorted((r["batch"], r["n_rows"], r["n_positives"], r["largest"]) for r in read_counts(spark, saved).collect())
    assert counts == [(0, 3, 2, 3), (1, 0, 0, None)]
    assert marks.read_mark(spark, saved) == 3


def test_training_reads_hashed_rows_and_gives_the_same_model(spark, monkeypatch):
    kept = []
    stored = training.stored
    monkeypatch.setattr(training, "stored", lambda df, name: kept.append(df.columns) or stored(df, name))
    rows = [([f"a{at % 3}", "b"], [f"c{at % 5}"], at % 2) for at in range(40)]
    df = spark.createDataFrame(rows, "tag_words array<string>, meta_words array<string>, label int")
    params = TrainingParams([1, 2], 0.01, 5, 1 << 8)
    model = training.train(df, params)
    assert kept == [["tf", "label"]]
    whole = training.classifier(params).fit(df)
    assert model.stages[-1].coefficients.toArray() == pytest.approx(whole.stages[-1].coefficients.toArray(), abs=1e-9)
    assert [type(stage) for stage in model.stages] == [type(stage) for stage in whole.stages]

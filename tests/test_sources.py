import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pagesieve.schemas import INCOMING
from pagesieve.sources import files, lines, marks, pages, results
from pagesieve.sources.params import read_params


@pytest.fixture
def small_blocks(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "200")
    yield
    spark.conf.set(name, before)


def test_lines_keep_their_numbers(spark, tmp_path, small_blocks):
    """Two files, each read in many blocks."""
    folder = tmp_path / "words"
    folder.mkdir()
    words = [f"w{at:04d}" for at in range(400)]
    (folder / "part-0.txt").write_text("\n".join(words[:150]) + "\n")
    (folder / "part-1.txt").write_text("\n".join(words[150:]) + "\n")
    assert spark.read.text(str(folder)).rdd.getNumPartitions() > 4
    read = lines.read_vocabulary(spark, str(folder))
    assert sorted((row["id"], row["word"]) for row in read.collect()) == list(enumerate(words))


def test_vocabulary_files(spark, tmp_path):
    vocabulary = spark.createDataFrame([("b", 1), ("</s>", 0), ("网", 2)], "word string, id long")
    lines.write_vocabulary(vocabulary, str(tmp_path / "v"))
    back = lines.read_vocabulary(spark, str(tmp_path / "v"))
    assert {tuple(row) for row in back.collect()} == {tuple(row) for row in vocabulary.collect()}
    lines.write_vocabulary_size(vocabulary, str(tmp_path / "n"))
    assert spark.read.text(str(tmp_path / "n")).first()["value"] == "3"


def test_vector_files(spark, tmp_path):
    path = tmp_path / "vectors.txt"
    path.write_text("3 2\n网 1 2.5\nb -1e-3 0 \nc 4 5\n")
    read = lines.read_vectors(spark, str(path))
    rows = sorted((row["id"], row["word"], [round(x, 6) for x in row["vector"]]) for row in read.collect())
    assert rows == [(0, "网", [1.0, 2.5]), (1, "b", [-0.001, 0.0]), (2, "c", [4.0, 5.0])]
    lines.write_vectors(read, str(tmp_path / "copy"))
    copy = lines.read_vectors(spark, str(tmp_path / "copy"))
    assert sorted(copy.collect(), key=str) == sorted(read.collect(), key=str)
    assert lines.vocabulary_of(read).columns == ["word", "id"]


def test_stop_words(spark, tmp_path):
    path = tmp_path / "stop.txt"
    path.write_text("首页\n 尾页\t\n首页\n")
    assert {row["word"] for row in lines.read_stop_words(spark, str(path)).collect()} == {"首页", "尾页"}


def test_snapshots(spark, tmp_path):
    root = tmp_path / "share"
    (root / "a").mkdir(parents=True)
    (root / "a" / "1.html").write_bytes("网贷\r\n".encode())
    (root / "a" / "2.html").write_bytes(b"\xff\xfe")
    (root / "3.txt").write_bytes(b"x")
    read = pages.read_snapshots(spark, str(root), "*.html").collect()
    assert {tuple(row) for row in read} == {("a/1.html", "网贷\r\n"), ("a/2.html", None)}
    every = pages.read_snapshots(spark, f"file://{root}/").collect()
    assert {row["file_path"] for row in every} == {"a/1.html", "a/2.html", "3.txt"}


def test_snapshots_by_name(spark, tmp_path):
    stored = [("a/1.html", "网贷\r\n".encode()), ("a/2.html", b"\xff\xfe"), ("b/3.html", b""), (None, b"x"), ("c", None)]
    df = spark.createDataFrame(stored, "file_path string, content binary")
    sizes = files.store_snapshots(df, str(tmp_path)).collect()
    assert {tuple(row) for row in sizes} == {("a/1.html", 8), ("a/2.html", 2), ("b/3.html", 0)}
    names = ["a/1.html", "a/1.html", "a/2.html", "b/3.html", "b/missing.html", None]
    rows = spark.createDataFrame([(at, name, "old") for at, name in enumerate(names)], "id int, file_path string, html string")
    expected = [(0, "网贷\r\n"), (1, "网贷\r\n"), (2, None), (3, ""), (4, None), (5, None)]
    for root, tasks in ((str(tmp_path), None), (f"file://{tmp_path}/", 3)):
        found = files.fetch_snapshots(rows, root, tasks=tasks)
        assert found.columns == ["id", "file_path", "html"]
        assert sorted((row["id"], row["html"]) for row in found.collect()) == expected
    assert files.fetch_snapshots(rows.where("id < 0"), str(tmp_path)).count() == 0


def test_copies(spark, tmp_path):
    (tmp_path / "1.html").write_text("x")
    rows = [(f"file://{tmp_path}/{name}", f"file://{tmp_path}/new/2024-01-31/{name}") for name in ("1.html", "2.html")]
    df = spark.createDataFrame(rows, "src string, dst string")
    for _ in range(2):
        done = results.copy_files(df, "src", "dst").collect()
        assert {row["source"][-6:]: row["copied"] for row in done} == {"1.html": True, "2.html": False}
    assert (tmp_path / "new" / "2024-01-31" / "1.html").read_text() == "x"


def test_incoming_rows(spark):
    rows = [(at, "s", "d", "u", None if at == 4 else f"f{at}") for at in range(1, 6)]
    table = spark.createDataFrame(rows, INCOMING)
    fresh = pages.incoming_rows(table, 2)
    assert sorted(row["offset"] for row in fresh.collect()) == [3, 5]
    assert fresh.columns == ["offset", "website_name", "domain", "url", "file_path"]
    assert pages.incoming_rows(table, 5).count() == 0


def test_labelled_rows(spark):
    rows = [(1, "1", "trainset"), (2, "0", "testset"), (3, "bad", "testset")]
    table = spark.createDataFrame(rows, "id long, label string, class string")
    assert [tuple(row) for row in pages.labelled_rows(table, "trainset", ["id"]).collect()] == [(1, 1)]
    with pytest.raises(PySparkException):
        pages.labelled_rows(table, "testset", ["id"]).collect()
    assert [row["id"] for row in pages.sample_rows(table, "testset", ["id"], "id", 1).collect()] == [2]


def test_params(spark, tmp_path):
    path = tmp_path / "params.json"
    path.write_text('{\n "filter_sizes": "1, 3",\n "l2_reg_lambda": 0.5,\n "num_hidden": 100\n}\n')
    params = read_params(spark, str(path))
    assert (params.filter_sizes, params.l2_reg_lambda, params.num_epochs) == ([1, 3], 0.5, 200)


def test_marks(spark, tmp_path):
    path = str(tmp_path / "marks")
    assert marks.read_mark(spark, path) == 0
    marks.advance_mark(spark, path, 7)
    marks.advance_mark(spark, path, 5)
    assert marks.read_mark(spark, path) == 7
    marks.reset_mark(spark, path)
    assert marks.read_mark(spark, path) == 0
    marks.advance_mark(spark, path, 3)
    assert marks.read_mark(spark, path) == 3


def test_buckets(spark):
    df = spark.createDataFrame([("share_disk/a",), ("other/b",), (None,)], "p string")
    found = results.with_bucket(df, "p", {"share_disk": "x"}, strict=False)
    assert [row["bucket"] for row in found.collect()] == ["x", None, None]
    with pytest.raises(PySparkException, match="no bucket for other"):
        results.with_bucket(df, "p", {"share_disk": "x"}).collect()


def test_archive(spark, tmp_path):
    positives = spark.createDataFrame([(1, "a/1.html"), (2, "b/1.html")], "offset long, file_path string")
    snapshots = spark.createDataFrame([("a/1.html", "x"), ("c", "y")], "file_path string, html string")
    day = F.lit(datetime.date(2024, 1, 31))
    rows = results.archived(positives, snapshots, "root", day, "offset")
    for run in ("r1", "r1", "r2"):
        results.write_archive(rows.where("html is not null"), str(tmp_path / "archive"), run)
    back = spark.read.parquet(str(tmp_path / "archive" / "dt=2024-01-31")).collect()
    assert [(row["dst"], row["html"]) for row in back] == [("root/2024-01-31/1.html", "x")] * 2


def test_stored_leaves_no_shuffle_files(spark):
    from pyspark.sql import functions as F

    from pagesieve.session import CLEANUP, stored

    def shuffles():
        tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
        return tracker.shuffleStatuses().size()

    before = shuffles()
    counts = stored(spark.range(1000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert shuffles() <= before and spark.conf.get(CLEANUP) == "false"
    assert counts.agg(F.sum("count")).first()[0] == 1000

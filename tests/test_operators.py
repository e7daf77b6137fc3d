import itertools
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pagesieve.functions.text import split_words
from pagesieve.operators.clean import Cleaning, clean_text, dictionary_splitter, joined_text, letter_splitter
from pagesieve.operators.encode import encode
from pagesieve.operators.metrics import evaluate, write_metrics
from pagesieve.operators.ngrams import runs_of
from pagesieve.operators.pooling import pool_vectors
from pagesieve.operators.segment import cut, pieces_of, segment, with_beginnings, word_filter
from pagesieve.operators.skew import skew_join
from pagesieve.operators.stopwords import drop_stop_words
from pagesieve.operators.tfidf import document_frequencies, top_words, word_lists
from pagesieve.operators.vocabulary import number_words, vocabulary_size, word_frequencies


def texts(spark, rows):
    df = spark.createDataFrame(list(enumerate(rows)), "id long, text string")
    return df.select("id", split_words(F.col("text")).alias("words"))


def words_frame(spark, words):
    return spark.createDataFrame([(word,) for word in words], "word string")


# -- skew


@pytest.mark.parametrize("how", ["left", "left_anti"])
def test_skew_join_is_a_join(spark, how):
    rows = [(at, "hot" if at % 3 else f"k{at % 7}") for at in range(60)] + [(99, None), (100, None)]
    left = spark.createDataFrame(rows, "id long, key string")
    right = spark.createDataFrame([("hot", 1), ("k0", 2), ("k0", 3), ("zz", 4), (None, 5)], "key string, v int")
    plain = left.join(right, "key", how)
    split = skew_join(left, right, "key", how, spread=[F.col("id")], piece_rows=4)
    columns = sorted(plain.columns)
    assert sorted(split.columns) == columns
    ours, theirs = ([tuple(row) for row in df.select(columns).collect()] for df in (split, plain))
    assert sorted(ours, key=repr) == sorted(theirs, key=repr)


def test_skew_join_with_a_wrong_histogram(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "id long, key string")
    right = spark.createDataFrame([("a", 1), ("b", 2)], "key string, v int")
    told = spark.createDataFrame([("a", 50), ("c", 70)], "key string, key_rows long")
    found = skew_join(left, right, "key", spread=[F.col("id")], histogram=told, piece_rows=10)
    assert sorted(tuple(row) for row in found.select("id", "v").collect()) == [(1, 1), (2, 2)]


# -- ranking


def ranked_by_hand(rows, topn, known=None):
    lists = [row.split() for row in rows]
    df, n = known or (Counter(word for words in lists for word in set(words)), len(lists))
    found = {}
    for at, words in enumerate(lists):
        score = {
            word: round(tf / len(words) * math.log((1 + n) / (1 + df.get(word, 0))), 9)
            for word, tf in Counter(words).items()
        }
        found[at] = sorted(score, key=lambda word: (-score[word], word))[:topn]
    return found


def lists_of(ranked):
    return {row["id"]: row["words"] for row in word_lists(ranked, "id").collect()}


def test_top_words(spark):
    random.seed(3)
    rows = [" ".join(random.choices("abcdefghij", k=random.randint(1, 30))) for _ in range(40)] + [""]
    found = lists_of(top_words(texts(spark, rows), "id", "words", topn=4))
    expected = ranked_by_hand(rows, 4)
    assert expected.pop(40) == []
    assert found == expected


@pytest.mark.parametrize("common_words", [1, 5, 1000])
def test_top_words_leave_before_the_shuffle(spark, common_words):
    from pagesieve.operators.tfidf import candidates

    random.seed(8)
    names = [f"w{at}" for at in range(300)]
    weights = [1 / (1 + at) for at in range(300)]
    rows = [" ".join(random.choices(names, weights, k=random.randint(0, 200))) for _ in range(80)]
    rows = [row for row in rows if row]
    df = texts(spark, rows)
    found = lists_of(top_words(df, "id", "words", topn=5, common_words=common_words))
    assert found == ranked_by_hand(rows, 5)
    known = spark.createDataFrame([("w0", 70, 90), ("w1", 2, 90)], "word string, df long, n_docs long")
    found = lists_of(top_words(df, "id", "words", known, topn=5, common_words=common_words))
    assert found == ranked_by_hand(rows, 5, ({"w0": 70, "w1": 2}, 90))
    if common_words == 1000:  # every count known: hardly more than the best is left
        left = candidates(df, "id", "words", document_frequencies(df, "words"), 5, False, common_words)
        assert left.count() < sum(len(set(row.split())) for row in rows) / 3


def test_top_words_split_each_text_once(spark):
    rows = ["a b c", "a a b", "", "c d"]
    made = spark.sparkContext.accumulator(0)

    def split(text):
        made.add(1)
        return text.split()

    df = spark.createDataFrame(list(enumerate(rows)), "id long, text string")
    df = df.select("id", F.udf(split, "array<string>")("text").alias("words"))
    top_words(df, "id", "words").collect()
    assert made.value == len(rows)


def test_bags_hold_distinct_words_and_the_length_of_the_list(spark):
    from pagesieve.operators.tfidf import word_bags

    rows = [(1, ["b", None, "a", "b"]), (2, []), (3, None), (None, ["c"])]
    df = spark.createDataFrame(rows, "id long, words array<string>")
    found = {row["id"]: (row["n_words"], dict(zip(row["words"], row["tf"], strict=True))) for row in word_bags(df, "id", "words").collect()}
    assert found == {1: (4, {"a": 1, "b": 2}), 2: (0, {}), 3: (0, {}), None: (1, {"c": 1})}


def test_blocks_name_a_word_once_for_all_their_texts(spark):
    import numpy as np

    from pagesieve.operators.tfidf import block_frequencies, word_blocks

    rows = [(1, ["b", None, "a", "b"]), (2, []), (3, None), (None, ["c", "a"])]
    df = spark.createDataFrame(rows, "id long, words array<string>").coalesce(1)
    (block,) = word_blocks(df, "id", "words").collect()
    assert block["keys"] == [1, 2, 3, None] and block["n_words"] == [4, 0, 0, 2] and block["sizes"] == [2, 0, 0, 2]
    assert sorted(map(tuple, block["words"])) == [("a", 2), ("b", 1), ("c", 1)]
    code, tf = (np.frombuffer(block[name], "<i4").tolist() for name in ("codes", "tf"))
    found = [(block["words"][at]["word"], n) for at, n in zip(code, tf, strict=True)]
    assert sorted(found[:2]) == [("a", 1), ("b", 2)] and sorted(found[2:]) == [("a", 1), ("c", 1)]
    counts = block_frequencies(word_blocks(df, "id", "words"))
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, document_frequencies(df, "words").collect()))


@pytest.mark.parametrize("common_words", [1, 30, 1000])
def test_top_words_over_several_blocks(spark, common_words):
    from pagesieve.operators.tfidf import word_blocks

    random.seed(12)
    names = [f"w{at}" for at in range(200)]
    rows = [" ".join(random.choices(names[at // 20 :], k=random.randint(1, 12))) for at in range(2500)]
    df = texts(spark, rows).coalesce(1)
    blocks = word_blocks(df, "id", "words").collect()
    assert len(blocks) > 1  # words are named once a block, not once a text
    assert sum(len(block["words"]) for block in blocks) < sum(sum(block["sizes"]) for block in blocks) / 10
    assert lists_of(top_words(df, "id", "words", topn=5, common_words=common_words)) == ranked_by_hand(rows, 5)


def test_top_words_by_known_frequencies(spark):
    known = spark.createDataFrame([("a", 9, 10), ("b", 1, 10)], "word string, df long, n_docs long")
    rows = ["a b c", "a a b", "c d"]
    found = lists_of(top_words(texts(spark, rows), "id", "words", known))
    assert found == ranked_by_hand(rows, 20, ({"a": 9, "b": 1}, 10))


def test_frequencies(spark):
    found = document_frequencies(texts(spark, ["a a b", "a", ""]), "words").collect()
    assert sorted(map(tuple, found)) == [("a", 2, 3), ("b", 1, 3)]


# -- stop words


@pytest.mark.parametrize("in_row_words", [100, 0])
def test_stop_words(spark, in_row_words):
    df = texts(spark, ["理财 首页 投资 首页", "首页", "", "投资"])
    stop = words_frame(spark, ["首页", "", "首页"])
    kept = drop_stop_words(df, "id", ["words"], stop, in_row_words)
    assert {row["id"]: row["words"] for row in kept.collect()} == {0: ["理财", "投资"], 1: [], 2: [], 3: ["投资"]}


# -- segmentation


def best_cut(text, weights, floor):
    """Every way to cut the text, weighed."""
    if not text:
        return 0.0
    best = None
    for bars in itertools.product([0, 1], repeat=max(len(text) - 1, 0)):
        ends = [at + 1 for at, bar in enumerate(bars) if bar] + [len(text)]
        words = [text[a:b] for a, b in zip([0, *ends], ends)]
        if any(len(word) > 1 and word not in weights for word in words):
            continue
        weight = sum(weights.get(word, floor) for word in words)
        if best is None or weight > best:
            best = weight
    return best


def test_cut_finds_the_best_path():
    random.seed(5)
    for _ in range(60):
        words = {"".join(random.choices("网贷理财投", k=random.randint(1, 4))): random.randint(1, 50) for _ in range(12)}
        total = sum(words.values())
        floor = -math.log(total)
        weights = {word: math.log(freq) + floor for word, freq in words.items()}
        text = "".join(random.choices("网贷理财投x", k=random.randint(0, 9)))
        found = cut(text, with_beginnings(weights), floor)
        assert "".join(found) == text
        assert sum(weights.get(word, floor) for word in found) == pytest.approx(best_cut(text, weights, floor))


def test_segment(spark):
    dictionary = spark.createDataFrame(
        [("网贷", 50), ("平台", 40), ("网贷平台", 1), ("理财", 30), ("理", 2), ("", 5)], "word string, freq long"
    )
    df = spark.createDataFrame(
        [(1, "网贷平台理财理x"), (2, ""), (3, None), (4, "无词")], "id long, text string"
    )
    expected = {1: ["网贷", "平台", "理财", "理", "x"], 2: [], 3: [], 4: ["无", "词"]}
    for piece_rows in (100, 1):
        both = df.withColumn("again", F.concat("text", F.lit("平台")))
        found = segment(both, "id", {"text": "words", "again": "more"}, dictionary, piece_rows).collect()
        assert {row["id"]: row["words"] for row in found} == expected
        assert {row["id"]: row["more"] for row in found} == {
            at: [*words, "平台"] if at != 3 else [] for at, words in expected.items()
        }


def test_segment_without_dictionary(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "id long, text string")
    nothing = spark.createDataFrame([], "word string, freq long")
    found = segment(df, "id", {"text": "words"}, nothing).collect()
    assert {row["id"]: row["words"] for row in found} == {1: ["a", "b"], 2: []}
    assert segment(df.where("id > 5"), "id", {"text": "words"}, nothing).isEmpty()


@pytest.mark.parametrize("bits", [20, 6])
def test_pieces_hold_every_word(spark, bits):
    """Also where the filter is much too small: it may let more through, never less."""
    random.seed(7)
    words = {"".join(random.choices("abc网😀", k=random.randint(1, 7))) for _ in range(40)}
    dictionary = spark.createDataFrame([(word,) for word in words], "word string").repartition(3)
    table = word_filter(dictionary, bits)
    texts = ["".join(random.choices("abc网😀 ", k=random.randint(0, 60))) for _ in range(50)]
    for text, pieces in zip(texts, pieces_of(texts, table, bits), strict=True):
        every = {text[a:b] for a in range(len(text)) for b in range(a + 1, len(text) + 1)}
        assert every & words <= pieces <= every
        if bits == 20:
            assert pieces == every & words


# -- cleaning


def test_clean_han_pages(spark):
    dictionary = spark.createDataFrame(
        [("个贷", 50), ("网贷", 50), ("平台", 40), ("理财", 30), ("首页", 30), ("投资", 20)], "word string, freq long"
    )
    rows = [
        (1, "P2P网贷", "理财", "平台", "<p>P2P首页</p>投资投资abc的"),
        (2, "网贷", None, "平台", "理财首页"),
        (3, "网贷", "首页", "平台", None),
    ]
    df = spark.createDataFrame(rows, "id long, title string, keywords string, description string, corpus string")
    stop = words_frame(spark, ["首页"])
    how = Cleaning(dictionary_splitter(dictionary), topn=20)
    known = spark.createDataFrame([("首页", 1, 9), ("投资", 3, 9)], "word string, df long, n_docs long")
    found = joined_text(clean_text(df, "id", stop, how, known))
    assert {row["id"]: (row["tag_words"], row["meta_words"]) for row in found.collect()} == {
        1: ("p2p 投资", "p2p 网贷 理财 平台"),  # 1/4 ln 10, 2/4 ln 2.5
        2: ("理财", ""),
        3: ("", "网贷 平台"),
    }
    plain = Cleaning(dictionary_splitter(dictionary), alias_meta=False)
    first = joined_text(clean_text(df, "id", stop, plain, known)).where("id = 1").first()
    assert first["meta_words"] == "网贷 理财 平台"


def test_meta_words_are_made_where_they_stay(spark):
    seen = []

    def split(df, key, columns):
        seen.append((set(columns), "tag_words" in df.columns))
        return letter_splitter()(df, key, columns)

    df = spark.createDataFrame([(1, "aa ", "bb ", "cc", "dd dd")], "id long, title string, keywords string, description string, corpus string")
    how = Cleaning(split, costly=False, keep=None, aliases=())
    row = clean_text(df, "id", words_frame(spark, ["bb"]), how).first()
    assert (row["tag_words"], row["meta_words"]) == (["dd"], ["aa", "cc"])
    assert ({"meta_text"}, True) in seen  # no word list of theirs is shuffled


def test_no_further_word_moves_up(spark):
    df = spark.createDataFrame([(1, "", "", "", "aa aa aa bb bb cc")], "id long, title string, keywords string, description string, corpus string")
    how = Cleaning(letter_splitter(), keep=None, aliases=(), topn=2)
    known = spark.createDataFrame([("zz", 1, 9)], "word string, df long, n_docs long")
    assert clean_text(df, "id", words_frame(spark, ["aa"]), how, known).first()["tag_words"] == ["bb"]


# -- vocabulary, encoding, pooling


def test_vocabulary(spark):
    vocabulary = number_words(word_frequencies(texts(spark, ["b a b", "c a </s>", "d b"]), "words"))
    assert sorted((row["id"], row["word"], row["freq"]) for row in vocabulary.collect()) == [
        (0, "</s>", 0), (1, "b", 3), (2, "a", 2), (3, "c", 1), (4, "d", 1),
    ]
    assert vocabulary_size(vocabulary).first()["n_words"] == 5


def test_vocabulary_over_many_partitions(spark):
    random.seed(8)
    counts = {f"w{at}": random.randint(1, 5) for at in range(3000)}
    df = spark.createDataFrame(list(counts.items()), "word string, freq long").repartition(7)
    found = {row["word"]: row["id"] for row in number_words(df).collect()}
    ordered = sorted(counts, key=lambda word: (-counts[word], word))
    assert found == {"</s>": 0, **{word: at + 1 for at, word in enumerate(ordered)}}


@pytest.mark.parametrize("with_freq", [True, False])
def test_encoding(spark, with_freq):
    vocabulary = spark.createDataFrame([("</s>", 0, 0), ("a", 1, 5), ("b", 2, 5)], "word string, id long, freq long")
    vocabulary = vocabulary if with_freq else vocabulary.drop("freq")
    df = texts(spark, ["a b", "a z b", "a b a b a", ""]).withColumn("other", F.array(F.lit("b")))
    found = encode(df, "id", vocabulary, {"text": ("words", 4), "meta": ("other", 2)}).collect()
    assert {row["id"]: (row["text"], row["meta"]) for row in found} == {
        0: ([1, 2, 0, 0], [2, 0]),
        1: ([1, 0, 2, 0], [2, 0]),
        2: ([1, 2, 1, 2], [2, 0]),
        3: ([0, 0, 0, 0], [2, 0]),
    }


def test_encoding_of_records_without_words(spark):
    vocabulary = spark.createDataFrame([("a", 1)], "word string, id long")
    found = encode(texts(spark, ["", "a"]), "id", vocabulary, {"text": ("words", 2)}).collect()
    assert {row["id"]: row["text"] for row in found} == {0: [0, 0], 1: [1, 0]}


def test_blocks_of_texts_are_bounded():
    """Pieces and words leave a task by blocks of characters, however many rows a batch has."""
    import pyarrow as pa

    from pagesieve.operators.segment import blocks

    assert list(blocks(pa.array([3, 4, 9, 1, 1, 0, 6]), 7)) == [(0, 2), (2, 3), (3, 6), (6, 7)]
    assert list(blocks(pa.array([], pa.int32()), 7)) == []


def test_segment_keeps_other_columns(spark, monkeypatch):
    from pagesieve.operators import segment as module

    monkeypatch.setattr(module, "BLOCK", 4)
    dictionary = spark.createDataFrame([("ab", 5), ("c", 3)], "word string, freq long")
    rows = [(at, "abc" * (at % 4) or None, at * 0.5) for at in range(30)]
    df = spark.createDataFrame(rows, "id long, text string, x double")
    found = {row["id"]: (row["text"], row["x"], row["words"]) for row in segment(df, "id", {"text": "words"}, dictionary).collect()}
    assert found == {at: (text, x, ["ab", "c"] * (at % 4)) for at, text, x in rows}


def test_pooling(spark):
    vectors = spark.createDataFrame([(1, [1.0, -2.0]), (2, [3.0, -4.0])], "id long, vector array<float>")
    df = spark.createDataFrame([(7, [1, 2, 2, 0, 9]), (8, [0, 0])], "id long, ids array<long>")
    found = pool_vectors(df, "id", "ids", vectors).collect()
    assert len(found) == 1 and found[0]["id"] == 7
    assert list(found[0]["max_vector"]) == [3.0, -2.0]
    assert list(found[0]["mean_vector"]) == pytest.approx([7 / 3, -10 / 3])


@pytest.mark.parametrize("common_bytes", [1, 24, 1 << 20])
def test_pooling_by_common_and_rare_words(spark, common_bytes):
    """The same means and maxima wherever the vectors come from, and rows of one key as one."""
    import numpy as np

    from pagesieve.operators.pooling import window_pool

    random.seed(4)
    table = {at: [random.uniform(-1, 1) for _ in range(3)] for at in range(1, 30)}
    vectors = spark.createDataFrame([*table.items(), (30, None)], "id long, vector array<double>")
    rows = [(at // 2, [random.randint(0, 35) for _ in range(random.randint(0, 12))]) for at in range(60)] + [(None, [1, 2])]
    df = spark.createDataFrame(rows, "id long, ids array<long>")
    expected, windows = {}, []
    for key, ids in rows:
        held = [table[at] for at in ids if at in table]
        if held:
            expected.setdefault(key, []).extend(held)
            pairs = [np.mean(held[at : at + 2], axis=0) for at in range(len(held) - 1)] or [np.mean(held, axis=0)]
            windows.append((str(key), *np.max(pairs, axis=0).round(9)))
    found = pool_vectors(df, "id", "ids", vectors, common_bytes=common_bytes).collect()
    assert {row["id"] for row in found} == set(expected) and len(found) == len(expected)
    for row in found:
        assert np.allclose(row["max_vector"].toArray(), np.max(expected[row["id"]], axis=0))
        assert np.allclose(row["mean_vector"].toArray(), np.mean(expected[row["id"]], axis=0))
    pooled = window_pool(df, "id", "ids", vectors, (2,), common_bytes=common_bytes).collect()
    assert sorted((str(row["id"]), *np.round(row["pooled"], 9)) for row in pooled) == sorted(windows)
    assert window_pool(df, "id", "ids", vectors.limit(0), (2,)).isEmpty()


def test_runs(spark):
    found = runs_of(texts(spark, ["a b c"]), "id", "words", [1, 3]).collect()
    assert sorted((row["size"], row["place"], row["gram"]) for row in found) == [
        (1, 0, "a"), (1, 1, "b"), (1, 2, "c"), (3, 0, "a b c"),
    ]


def test_runs_are_cut_one_at_a_time(spark):
    rows = [(1, ["a", "b", None, "c"]), (2, ["x"]), (3, []), (4, None), (None, ["y", "z"])]
    df = spark.createDataFrame(rows, "id long, words array<string>")
    runs = runs_of(df, "id", "words", [1, 2, 3])
    expected = [
        (key, size, at, " ".join(word for word in words[at : at + size] if word is not None))
        for key, words in rows
        for size in (1, 2, 3)
        for at in range(len(words or []) - size + 1)
    ]
    assert sorted(map(tuple, runs.collect()), key=str) == sorted(expected, key=str)
    # No list of all runs, made by interpreted lambdas, before they are told apart.
    assert "transform(" not in runs._jdf.queryExecution().toString().lower()


# -- metrics


def test_metrics(spark, tmp_path):
    rows = [(1, 1, [0.2, 0.8]), (1, 0, [0.6, 0.4]), (0, 1, [0.3, 0.7]), (0, 0, [0.9, 0.1])]
    df = spark.createDataFrame(rows, "label int, classes int, probabilities array<double>")
    row = evaluate(df).first()
    assert (row["accuracy"], row["precision"], row["recall"], row["majority"]) == (0.5, 0.5, 0.5, 0.5)
    assert row["loss"] == pytest.approx(-sum(map(math.log, (0.8, 0.4, 0.3, 0.9))) / 4)
    none = evaluate(df.withColumn("classes", F.lit(0))).first()
    assert (none["precision"], none["recall"]) == (0.0, 0.0)
    sure = evaluate(df.withColumn("probabilities", F.expr("array(1.0D, 0.0D)"))).first()
    assert sure["loss"] > 300  # half of the rows are wrong for certain
    write_metrics(evaluate(df), str(tmp_path / "metrics"))
    assert spark.read.json(str(tmp_path / "metrics")).first()["accuracy"] == 0.5


def test_pooling_collects_no_lists_of_vectors(spark):
    """A text's vectors, and rows that share a key, stream through a task over many batches."""
    import numpy as np

    rng = np.random.default_rng(3)
    table = {at: [float(x) for x in rng.integers(-9, 9, 3)] for at in range(1, 2501)}
    rows = [("long", list(range(1, 2501))), ("none", [0, 9999]), ("no list", None)]
    rows += [(None if at % 2 else "often", [1 + at, 9999, 1 + at]) for at in range(2400)]
    df = spark.createDataFrame(rows, "id string, ids array<long>").repartition(3)
    vectors = spark.createDataFrame(list(table.items()), "id long, vector array<double>")
    pooled = pool_vectors(df, "id", "ids", vectors, common_bytes=48)
    plan = pooled._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan.split("MapInArrow")[0] and "collect_list" not in plan
    expected = {}
    for key, ids in rows:
        expected.setdefault(key, []).extend(table[word] for word in ids or [] if word in table)
    got = {row["id"]: row for row in pooled.collect()}
    assert set(got) == {key for key, held in expected.items() if held}
    for key, row in got.items():
        assert np.allclose(row["max_vector"].toArray(), np.max(expected[key], axis=0))
        assert np.allclose(row["mean_vector"].toArray(), np.mean(expected[key], axis=0))


def test_window_pool_against_brute_force(spark):
    import numpy as np

    from pagesieve.operators.pooling import window_pool

    vectors = {i: [float(i), float(-i * i % 7)] for i in range(1, 9)}
    rows = [(1, [1, 2, 3, 4]), (2, [5, 0, 99, 6]), (3, [7]), (4, [0, 99]), (5, []), (1, [8, 8]), (6, None)]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    table = spark.createDataFrame(list(vectors.items()), "id int, vector array<float>")
    got = sorted((r["doc_id"], tuple(r["pooled"])) for r in window_pool(df, "doc_id", "ids", table).collect())

    def by_hand(ids):
        known = [vectors[i] for i in ids or [] if i in vectors]
        if not known:
            return None
        pooled = []
        for k in (1, 2, 3):
            windows = [known[a : a + k] for a in range(len(known) - k + 1)] or [known]
            means = [np.mean(np.array(w), axis=0) for w in windows]
            pooled += list(np.max(np.array(means), axis=0))
        return tuple(pooled)

    expected = sorted((key, by_hand(ids)) for key, ids in rows if by_hand(ids) is not None)
    assert [key for key, _ in got] == [key for key, _ in expected]
    for (_, a), (_, b) in zip(got, expected):
        assert np.allclose(a, b)


def test_learned_vectors_place_synonyms_near(spark):
    import random

    import numpy as np

    from pagesieve.operators.vocabulary import learn_vectors, number_words, word_frequencies

    draw = random.Random(5)
    fill = [f"f{i}" for i in range(30)]
    rows = []
    for i in range(600):
        # "cat" and "kitten" share their neighbours; "engine" keeps other company.
        pet = draw.choice(["cat", "kitten"])
        rows.append((i, ["the", "small", pet, "purrs", "softly", *draw.sample(fill, 3)]))
        rows.append((1000 + i, ["the", "loud", "engine", "roars", "hard", *draw.sample(fill, 3)]))
    rows += [(5000, None), (5001, [])]
    texts = spark.createDataFrame(rows, "doc_id long, words array<string>").repartition(1)
    vocabulary = number_words(word_frequencies(texts.where("words is not null"), "words"))

    def vectors():
        found = learn_vectors(texts, "words", vocabulary, size=16, min_count=5, window=3, seed=1, partitions=1)
        return {row["word"]: np.array(row["vector"]) for row in found.collect()}

    first, again = vectors(), vectors()
    assert first.keys() == again.keys() and all(np.array_equal(first[w], again[w]) for w in first)

    def cos(a, b):
        return float(first[a] @ first[b] / np.linalg.norm(first[a]) / np.linalg.norm(first[b]))

    assert cos("cat", "kitten") > cos("cat", "engine") + 0.2


def test_stop_words_by_join_send_back_only_what_a_row_holds(spark):
    rows = [(1, ["a", None, "b", "a", "c", "b"]), (2, None), (3, []), (4, ["c", None]), (5, ["a"])]
    df = spark.createDataFrame(rows, "id long, words array<string>")
    kept = drop_stop_words(df, "id", ["words"], words_frame(spark, ["a", "b"]), in_row_words=0, piece_rows=1)
    assert {row["id"]: row["words"] for row in kept.collect()} == {1: [None, "c"], 2: None, 3: [], 4: ["c", None], 5: []}
    assert "posexplode" not in kept._jdf.queryExecution().toString().lower()


def test_training_tasks_grow_with_the_text(spark):
    from pagesieve.operators.vocabulary import training_tasks

    texts = spark.createDataFrame([(["a"] * 7,), (["b"] * 6,), ([],), (None,)], "words array<string>")
    assert training_tasks(texts, "words", 2, task_words=7) == 2
    assert training_tasks(texts, "words", 2, task_words=3) == 5
    assert training_tasks(texts.limit(0), "words", 4) == 4


@pytest.mark.parametrize("common_words", [0, 1, 3, 100])
def test_segment_by_common_and_rare_words(spark, common_words):
    """The same cuts wherever a word's weight comes from: a rare word may begin like a common one,
    be its beginning or hold it, and is forgotten with its text."""
    random.seed(11)
    dictionary = {"a": 9, "ab": 50, "abc": 3, "abcd": 40, "bc": 2, "cd": 30, "d": 4, "dd": 1, "网": 20, "网贷b": 2}
    floor = -math.log(sum(dictionary.values()))
    weights = {word: math.log(freq) + floor for word, freq in dictionary.items()}
    rows = [(at, "".join(random.choices("abcd网贷", k=random.randint(0, 9)))) for at in range(60)] + [(100, None)]
    df = spark.createDataFrame(rows, "id long, text string").repartition(3)
    table = spark.createDataFrame(list(dictionary.items()), "word string, freq long")
    for part_pieces in (1 << 20, 7):
        made = segment(df, "id", {"text": "words"}, table, common_words=common_words, part_pieces=part_pieces)
        found = {row["id"]: row["words"] for row in made.collect()}
        assert found == {at: cut(text or "", with_beginnings(weights), floor) for at, text in rows}


def test_common_words_are_weighed_where_they_are(spark):
    from pagesieve.operators.segment import most_frequent, weigh_common

    table = spark.createDataFrame([("a", 9), ("b", 5), ("c", 5), ("d", 1)], "word string, freq long")
    common = most_frequent(table, 2)
    assert [tuple(row) for row in common.orderBy("word").collect()] == [("a", 9), ("b", 5)]
    rows = [(1, ["a", "c", "a", "b", None, "c"]), (2, None), (3, []), (4, ["d"]), (5, ["b"])]
    df = spark.createDataFrame(rows, "id long, words array<string>").coalesce(1)
    weighed = weigh_common(df, "words", common.select("word", (F.col("freq") * 1.0).alias("weight")))
    assert {row["id"]: (row["words"], row["common_weight"]) for row in weighed.collect()} == {
        1: (["c", None, "c"], 23.0), 2: ([], 0.0), 3: ([], 0.0), 4: (["d"], 0.0), 5: ([], 5.0),
    }
    assert weigh_common(df, "words", common.limit(0).select("word", F.lit(1.0).alias("weight"))).agg(F.sum("common_weight")).first()[0] == 0


def test_texts_cut_by_the_corpus_shuffle_only_their_rare_words(spark):
    """What is exploded and joined word by word are the words that no task has at hand."""
    from pagesieve import queries

    table = queries.cut_weights(spark, "/root/testdata/sf0.001")
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert "common_weight" in plan and table.where("rebuilt and weight > spaced_weight - 1e-6").count() > 150

from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagesieve.functions import text as T
from pagesieve.functions.domains import TWO_LABEL_SUFFIXES, host_of, top_domain
from pagesieve.functions.paths import archive_path, basename, drop_first_slash, first_segment, join_path
from pagesieve.functions.scores import chosen_class, chosen_probability, softmax_pair


def values(spark, column, rows, schema="s string"):
    df = spark.createDataFrame([(at, row) for at, row in enumerate(rows)], f"id int, {schema}")
    return [row[0] for row in df.orderBy("id").select(column).collect()]


def test_aliases(spark):
    s = F.col("s")
    filtered = T.keep_characters(T.replace_aliases(s))
    assert values(spark, filtered, ["P2P网贷", "p2p", "abc", None]) == ["个贷网贷", "个贷", "", None]
    assert values(spark, T.restore_aliases(s), ["个贷 网贷", "个贷款"]) == ["p2p 网贷", "p2p款"]
    odd = [("a.b", "x$1\\y")]
    assert values(spark, T.replace_aliases(s, odd), ["a.b A.B acb"]) == ["x$1\\y x$1\\y acb"]


def test_meta(spark):
    rows = [("甲", "乙", "丙"), ("甲", None, "丙"), (None, "乙", "丙")]
    df = spark.createDataFrame(rows, "t string, k string, d string")
    fields = F.col("t"), F.col("k"), F.col("d")
    found = df.select(T.concat_meta(*fields), T.merge_meta(*fields)).collect()
    assert [tuple(row) for row in found] == [("甲乙丙", "甲乙丙"), (None, "甲nan丙"), (None, None)]


def test_word_lists(spark):
    s = F.col("s")
    assert values(spark, T.split_words(s), [" a  b\tc ", "", " "]) == [["a", "b", "c"], [], []]
    assert values(spark, T.letter_words(s), ["The big-X, ÄRGER 12 it!"]) == [["the", "big", "ärger", "it"]]
    assert values(spark, T.parse_ints(s), ["1, 2,3"]) == [[1, 2, 3]]
    words = T.split_words(s)
    assert values(spark, T.ngrams(words, 2), ["a b c", "a", ""]) == [["a b", "b c"], [], []]
    assert values(spark, T.ngrams(words, 1), ["a b"]) == [["a", "b"]]


lists = st.lists(st.lists(st.sampled_from(["a", "b", "ab", "ä", "网贷"]), max_size=12), min_size=1, max_size=20)


@settings(max_examples=8, deadline=None)
@given(lists)
def test_word_counts(spark, rows):
    found = values(spark, T.word_counts(F.col("s")), rows, "s array<string>")
    assert [{entry["word"]: entry["tf"] for entry in row} for row in found] == [dict(Counter(row)) for row in rows]


@settings(max_examples=8, deadline=None)
@given(lists, st.integers(0, 6))
def test_fixed_length(spark, rows, length):
    found = values(spark, T.fixed_length(F.col("s"), length, F.lit("</s>")), rows, "s array<string>")
    for row, kept in zip(rows, found):
        assert len(kept) == length
        assert kept == (row + ["</s>"] * length)[:length]


@settings(max_examples=8, deadline=None)
@given(lists)
def test_without(spark, rows):
    dropped = F.array(F.lit("a"), F.lit("网贷"), F.lit("zz"))
    found = values(spark, T.without(F.col("s"), dropped), rows, "s array<string>")
    assert found == [[word for word in row if word not in ("a", "网贷")] for row in rows]


DOMAINS = {
    "www.a.com.cn": "a.com.cn",
    "x.a.gov.cn": "a.gov.cn",
    "a.b.com": "b.com",
    "com.cn": "com.cn",
    "localhost": "localhost",
    ".com": "com",
    "1.2.3.4": "3.4",
    ".com.cn": ".com.cn",
    "": "",
    "..b": ".b",
    ".": "",
    "a.": "a.",
    "A.COM.CN": "COM.CN",
    "a.com.cn:80": "com.cn:80",
}


def by_hand(domain):
    """How many labels stay: three above a listed pair, else two, or the only one that is not empty."""
    labels = domain.split(".")
    listed = {tuple(suffix.split(".")[1:]) for suffix in TWO_LABEL_SUFFIXES}
    if len(labels) > 2 and tuple(labels[-2:]) in listed:
        kept = 3
    else:
        kept = 1 if len(labels) == 2 and not labels[0] else 2
    return ".".join(labels[-kept:])


def test_top_domain(spark):
    assert values(spark, top_domain(F.col("s")), list(DOMAINS)) == list(DOMAINS.values())
    assert values(spark, top_domain(F.col("s")), [None]) == [None]
    every = [f"www.a{suffix}" for suffix in TWO_LABEL_SUFFIXES]
    assert values(spark, top_domain(F.col("s")), every) == [f"a{suffix}" for suffix in TWO_LABEL_SUFFIXES]


parts = st.lists(st.sampled_from(["a", "www", ".", ".", "com", "cn", ".com.cn", ".gov.cn", "\n"]), max_size=6)


@settings(max_examples=10, deadline=None)
@given(st.lists(parts.map("".join), min_size=1, max_size=40))
def test_top_domain_like_the_rule(spark, domains):
    assert values(spark, top_domain(F.col("s")), domains) == [by_hand(domain) for domain in domains]


def test_top_domain_twice_is_once(spark):
    domains = ["www.a.com.cn", "a.b.com", "x.y.org.cn", "localhost"]
    once = top_domain(F.col("s"))
    assert values(spark, top_domain(once), domains) == values(spark, once, domains)


def test_host(spark):
    urls = ["http://a.b/c?d", "https://a.b:80/", "no url", None]
    assert values(spark, host_of(F.col("s")), urls) == ["a.b", "a.b", None, None]


def test_paths(spark):
    s = F.col("s")
    paths = ["/share_disk/a/b.html", "a/b/c", "c", None]
    assert values(spark, drop_first_slash(s), paths) == ["share_disk/a/b.html", "ab/c", "c", None]
    assert values(spark, basename(s), paths) == ["b.html", "c", "c", None]
    assert values(spark, first_segment(s), paths[1:]) == ["a", "c", None]
    day = F.lit("2024-01-31 23:59:00").cast("timestamp_ntz")
    assert values(spark, archive_path(s, "root/", day), paths[:1]) == ["root/2024-01-31/b.html"]
    assert values(spark, join_path(s, F.lit("x")), ["a", "a/", None]) == ["a/x", "a/x", None]


def test_decoding(spark):
    p = F.col("p")
    classes = chosen_class(p)
    rows = [[0.3, 0.7], [0.5, 0.5], [0.9, 0.1]]
    found = values(spark, F.struct(classes, chosen_probability(p, classes)), rows, "p array<double>")
    assert [tuple(row) for row in found] == [(1, 0.7), (0, 0.5), (0, 0.9)]
    pair = values(spark, softmax_pair(F.lit(0.0), F.col("z")), [0.0], "z double")[0]
    assert pair == [0.5, 0.5]

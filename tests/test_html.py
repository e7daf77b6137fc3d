import re

import pytest
from pyspark.sql import functions as F

from pagesieve.functions.html import META_RULES, page_attr, page_fields, parse_fields
from pagesieve.operators.features import join_features, page_features

RULES = {
    name: (rule.match_attr, re.compile(rule.pattern, re.IGNORECASE), rule.out_attr)
    for name, rule in META_RULES.items()
}

CASES = [
    (
        '<title>网贷A</title><meta name="Keywords" content="理财,投资"><meta name="description" content="平台">',
        ("网贷A", "理财,投资", "平台", "网贷理财投资平台"),
    ),
    ("<title>a &amp; b</title>", ("a & b", None, None, "")),
    ("<title></title>", (None, None, None, "")),
    ("<p>无标题</p>", (None, None, None, "无标题")),
    ('<input name="keywords"><meta name="keywords" content="x">', (None, None, None, "")),
    (
        '<meta name="twitter:description" content="t"><meta name="description" content="d">',
        (None, None, "t", ""),
    ),
]


def test_fields_of_pages(spark):
    rows = [(at, html) for at, (html, _) in enumerate(CASES)] + [(len(CASES), None)]
    pages = spark.createDataFrame(rows, "id int, html string")
    found = {
        row["id"]: (row["title"], row["keywords"], row["description"], row["corpus"])
        for row in page_features(pages).collect()
    }
    expected = {at: fields for at, (_, fields) in enumerate(CASES)}
    expected[len(CASES)] = (None, None, None, None)
    assert found == expected


@pytest.mark.parametrize(
    ("html", "title"),
    [
        ("<title>first</title><title>second</title>", "first"),
        ("<title>a<b>c</b></title>", None),
        ("<title><b>only</b></title>", "only"),
        ("<title>no end", "no end"),
        ("<head><title>closed by its parent</head><body>x", "closed by its parent"),
        ("<title>left open<p>x</p>", None),
        ("<title>stray</p> end</title>", "stray end"),
        ("<title> \n </title>", "\n"),
        ("<title>   </title>", " "),
        ("<title>&#20013;&#x4e2d;&nosuch;</title>", "中中&nosuch"),
        ("<title>a &amp</title>", "a &"),
        ("<script>'<title>no</title>'</script><title>yes</title>", "yes"),
        ("<!-- <title>no</title> --><title>yes</title>", "yes"),
        ("<svg><title>drawn</title></svg><title>page</title>", "drawn"),
        ("<title/>x<title>later</title>", None),
        ("<title>a<br></title>", None),
    ],
)
def test_title(html, title):
    assert parse_fields(html, {}, True).get("title") == title


@pytest.mark.parametrize(
    ("html", "keywords"),
    [
        ('<META NAME="KEYWORDS" CONTENT="A">', "A"),
        ('<meta content="a" name="x-keywords-y">', "a"),
        ('<meta name="keywords" content>', ""),
        ('<meta name="keywords" content="a &lt; b">', "a < b"),
        ('<!-- <meta name="keywords" content="no"> -->', None),
        ('<meta name="keywords" content="a" /><meta name="keywords" content="b">', "a"),
        ("<meta name=keywords content=bare>", "bare"),
        ("", None),
    ],
)
def test_keywords(html, keywords):
    assert parse_fields(html, RULES, True).get("keywords") == keywords


def test_attribute_of_any_rule(spark):
    pages = spark.createDataFrame([('<a href="x"></a><a href="/y" id="1"></a>',)], "html string")
    row = pages.select(
        page_attr(F.col("html"), "href", "^/", "href").alias("href"),
        page_attr(F.col("html"), "href", "^/", "id").alias("id"),
        page_fields(F.col("html")).alias("fields"),
    ).first()
    assert (row["href"], row["id"], row["fields"]["title"]) == ("/y", "1", None)


def test_aliases_survive_the_character_filter(spark):
    pages = spark.createDataFrame([("<p>P2P网贷</p>",)], "html string")
    assert page_features(pages).first()["corpus"] == "个贷网贷"
    assert page_features(pages, aliases=()).first()["corpus"] == "网贷"


def test_rows_keep_their_features(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "offset long, file_path string")
    features = spark.createDataFrame([("a", "x"), ("a", "y")], "file_path string, title string")
    joined = join_features(rows, features, "offset").select("offset", "title").collect()
    assert sorted(map(tuple, joined), key=repr) == [
        (1, "x"), (1, "y"), (2, "x"), (2, "y"), (3, None), (4, None),
    ]

"""Rows that share a key, or have none, keep each text of their own."""

from pagesieve.llm import near_dup
from pagesieve.llm.queries import LINKED

SCHEMA = "doc_id long, text string, part int"


def kept(spark, rows, parts):
    docs = spark.createDataFrame([(*row, at) for at, row in enumerate(rows)], SCHEMA).repartition(parts)
    found = near_dup.keep_one(docs)
    assert found.columns == docs.columns
    return sorted(((row.doc_id, row.text) for row in found.collect()), key=repr)


def test_each_text_of_a_shared_key_stays(spark):
    a, b, c = "a b c d e f", "g h i j k l", "m n o p q r"
    long = [f"w{at}" for at in range(60)]
    near = [" ".join(long), " ".join([*long, "x"])]
    cases = [
        # Every row without a key stands by its text.
        ([(None, a), (None, b), (None, c), (None, b)], [(None, a), (None, b), (None, c)]),
        # The copy goes, whichever key it repeats; a row with a key comes first.
        ([(1, a), (2, a), (2, None)], [(1, a), (2, None)]),
        ([(1, a), (2, a), (2, b), (None, b), (None, c)], [(1, a), (2, b), (None, c)]),
        # A key is no link: its second text is not drawn into the component of its first.
        ([(1, near[0]), (3, near[1]), (3, b), (3, c)], [(1, near[0]), (3, b), (3, c)]),
        # Near texts without keys or with one key are still near.
        ([(None, near[0]), (None, near[1]), (5, c)], 2),
        ([(7, near[0]), (7, near[1]), (7, near[1].upper())], 1),
        ([(None, None), (None, ""), (4, " "), (4, a), (4, a)], [(None, None), (None, ""), (4, " "), (4, a)]),
    ]
    for rows, want in cases:
        found = [kept(spark, rows, parts) for parts in (1, 3)]
        assert found[0] == found[1]
        assert len(found[0]) == want if isinstance(want, int) else found[0] == sorted(want, key=repr)


def test_links_without_keys(spark):
    rows = [(None, "a b c d"), (5, "a b c d"), (3, "x y z w"), (3, "a b c d"), (None, "q r s t"), (None, None)]
    found = near_dup.link(spark.createDataFrame(rows, "doc_id long, text string"), LINKED).collect()
    assert sorted(map(tuple, found), key=repr) == sorted([(None, 2, 3), (5, 2, 3), (3, 2, 3), (3, 2, 3), (None, 2, None), (None, 0, None)], key=repr)

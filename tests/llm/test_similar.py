import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagesieve.llm import fingerprints, near_dup
from pagesieve.llm.queries import LINKED


def components_by_hand(nodes, linked):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def linked_by_hand(texts, size, percent):
    sets = {}
    for key, text in texts.items():
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
        sets[key] = {tuple(words[at : at + size]) for at in range(max(1, len(words) - size + 1))} if words else set()
    common, held = Counter(), {}
    for key in sorted(sets):
        for shingle in sets[key]:
            common.update((other, key) for other in held.get(shingle, ()))
            held.setdefault(shingle, []).append(key)
    pairs = [(a, b) for (a, b), n in common.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]
    keys = sorted(sets)
    return {key: len(found) for key, found in sets.items()}, components_by_hand(keys, pairs)


def families(seed, members, words=120, rate=0.06):
    """Texts that drift from one another, so that many pairs lie around the threshold."""
    draw = random.Random(seed)
    base = [f"w{draw.randint(0, 10**6)}" for _ in range(words)]
    for _ in range(members):
        share = draw.uniform(0, rate)
        yield " ".join(f"v{draw.randint(0, 10**6)}" if draw.random() < share else word for word in base)


@pytest.mark.parametrize("how", [LINKED, near_dup.Likeness()])
def test_links_against_all_pairs(spark, how):
    texts = [*families(1, 120), *families(2, 60, 40, 0.2), *families(3, 40, 400, 0.12)]
    texts += ["Same text here", "same TEXT\there", "one", "one", "one two", None, "", " \n", None, "x " * 9000, "x " * 500]
    random.Random(1).shuffle(texts)
    table = dict(enumerate(texts))
    docs = spark.createDataFrame(list(table.items()), "doc_id long, text string").withColumn("rep", F.lit("clash")).repartition(5)
    found = near_dup.link(docs, how)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    sizes, component = linked_by_hand(table, how.shingle, how.percent)
    rows = {row.doc_id: row for row in found.collect()}
    assert {key: row.n_shingles for key, row in rows.items()} == sizes
    assert {key: row.component_id for key, row in rows.items()} == component
    kept = near_dup.keep_one(docs, how)
    assert kept.columns == docs.columns
    assert sorted(row.doc_id for row in kept.collect()) == sorted(set(component.values()))


def test_no_documents_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (2, None)], "doc_id long, text string")
    assert sorted(tuple(row) for row in near_dup.link(docs, LINKED).collect()) == [(1, 2, 1), (1, 2, 1), (2, 0, 2), (2, 2, 1)]
    assert sorted(row.doc_id for row in near_dup.keep_one(docs).collect()) == [1, 2]
    assert near_dup.link(docs.limit(0), LINKED).count() == 0
    assert near_dup.keep_one(docs.limit(0)).count() == 0


def test_components(spark):
    draw = random.Random(8)
    chain = [(at, at + 1) for at in range(100, 160)]
    star = [(300, at) for at in range(301, 400)]
    other = [(draw.randint(500, 700), draw.randint(500, 700)) for _ in range(90)]
    edges = [tuple(draw.sample(pair, 2)) for pair in [*chain, *star]] + other
    found = near_dup.components(spark.createDataFrame(edges, "u long, v long"))
    want = components_by_hand({x for pair in edges for x in pair}, edges)
    assert {row.node: row.label for row in found.collect()} == {a: b for a, b in want.items() if a != b}
    assert near_dup.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_every_bin_is_filled_and_likeness_is_estimated():
    random = np.random.default_rng(4)
    small = [np.sort(random.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 2, 5, 40)]
    table = near_dup.bin_sketch(small, 192)
    assert (table != np.iinfo(np.uint64).max).all()
    assert (near_dup.bin_sketch(small[::-1], 192)[::-1] == table).all()
    for share in (0.5, 0.8, 0.95):
        both = random.integers(0, 2**63, 2000).astype(np.uint64)
        common = int(2000 * share)
        pair = near_dup.bin_sketch([both, np.concatenate([both[:common], random.integers(0, 2**63, 2000 - common).astype(np.uint64)])], 1000)
        assert abs((pair[0] == pair[1]).mean() - common / (4000 - common)) < 0.06


# -- fingerprints


def test_equal_substrings_share_names(monkeypatch):
    monkeypatch.setattr(fingerprints, "KEPT", 10**6)
    draw = random.Random(3)
    line = lambda n: "".join(draw.choices("abcdeé  ", k=n)).encode()
    middle = line(3000)
    ((_, alone),) = fingerprints.sketches([middle])
    for _ in range(5):
        ((_, inside),) = fingerprints.sketches([line(draw.randint(1, 900)) + middle + line(draw.randint(1, 900))])
        assert len(np.intersect1d(alone, inside)) > 0.93 * len(alone)


def test_fingerprints_do_not_depend_on_company():
    draw = random.Random(7)
    texts = [bytes(draw.choices(b"ab\x00\xff ", k=draw.choice([0, 0, 1, 2, 3, 4, 9, 50, 700]))) for _ in range(200)]
    texts += [b"a" * 5000, b"ab" * 3000, b"\x00", b"\x00\x00", b"aaa"]
    together = fingerprints.fingerprint_texts(texts)
    assert together == [fingerprints.fingerprint_texts([text])[0] for text in texts]
    assert len(set(together)) == len(set(texts))
    for text, found in zip(texts, together, strict=True):
        assert fingerprints.likeness(found, found) == 1.0
        assert fingerprints.likeness(found, together[texts.index(b"")]) == (1.0 if not text else 0.0)


def test_labels_of_neighbours_differ():
    random = np.random.default_rng(2)
    for names in (random.integers(0, 256, 5000).astype(np.uint8), random.integers(0, 2**63, 5000).astype(np.uint64)):
        names = names[np.concatenate([[True], names[1:] != names[:-1]])]
        labels = fingerprints.labels_of(names, np.array([0]))
        assert labels.max() < 6 and (labels[1:] != labels[:-1]).all()


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_neighbours(spark, parts):
    draw = random.Random(parts)
    texts = ["".join(draw.choices("abc é漢\n", k=draw.choice([0, 1, 2, 3, 10, 300]))) for _ in range(60)] + [None, "", "long " * 30_000]
    keys = draw.sample(range(-500, 500), len(texts))
    docs = spark.createDataFrame(list(zip(keys, texts, strict=True)), "doc_id long, text string").withColumn("part", F.lit("clash")).repartition(parts)
    rows = {row.doc_id: row for row in fingerprints.compare_neighbours(docs).collect()}
    assert len(rows) == len(texts)
    order = sorted(zip(keys, (x or "" for x in texts), strict=True), reverse=True)
    for (key, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        third = len(text) // 3
        changed = (text[: len(text) - third] + after[:third]).encode()
        row = rows[key]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(changed).hexdigest())
        prints = fingerprints.fingerprint_texts([text.encode(), changed, after.encode()])
        assert [bytes(row.fingerprint), bytes(row.edited_fingerprint)] == prints[:2]
        assert row.near_edited == fingerprints.likeness(prints[0], prints[1])
        assert row.near_next == fingerprints.likeness(prints[0], prints[2])
    alone = {row.doc_id: bytes(row.fingerprint) for row in fingerprints.with_fingerprints(docs, ["doc_id"]).collect()}
    assert alone == {key: bytes(row.fingerprint) for key, row in rows.items()}


def test_few_neighbours(spark):
    docs = spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")
    row = fingerprints.compare_neighbours(docs).first()
    assert row.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and row.near_next == 1.0
    assert fingerprints.compare_neighbours(docs.limit(0)).count() == 0
    tied = spark.createDataFrame([(5, "abcdef"), (5, "xyz"), (None, "q")], "doc_id long, text string")
    assert fingerprints.compare_neighbours(tied).count() == 3


def test_dense_family_in_many_tiles(spark, monkeypatch):
    # Small tiles, so that the family's buckets are cut into many of them.
    monkeypatch.setattr(near_dup, "TILE", 40)
    texts = [*families(5, 300, 60, 0.1), *families(6, 80, 30, 0.3)]
    table = dict(enumerate(texts))
    docs = spark.createDataFrame(list(table.items()), "doc_id long, text string").repartition(7)
    found = {row.doc_id: row.component_id for row in near_dup.link(docs, LINKED).collect()}
    _, component = linked_by_hand(table, LINKED.shingle, LINKED.percent)
    assert found == component


def test_a_tile_gives_a_spanning_forest():
    import pandas as pd

    draw = random.Random(3)
    base = list(range(100))
    sets = [sorted({x if draw.random() > 0.03 else 1000 + draw.randint(0, 10**6) for x in base}) for _ in range(300)]
    frame = pd.DataFrame(
        {"rep": range(300), "comp": range(300), "block": [i % 2 for i in range(300)], "kind": 0, "lo": 0, "hi": 1, "shingles": sets}
    )
    links = near_dup.tile_links(frame, 85)
    assert len(links) < 300
    assert all(a % 2 != b % 2 for a, b in links)
    # The forest joins exactly what all cross-block pairs join.
    pairs = []
    for i in range(300):
        for j in range(i + 1, 300):
            if i % 2 != j % 2:
                common = len(set(sets[i]) & set(sets[j]))
                if 100 * common >= 85 * (len(sets[i]) + len(sets[j]) - common):
                    pairs.append((i, j))
    assert components_by_hand(range(300), links) == components_by_hand(range(300), pairs)


def test_a_hot_key_is_spread_over_ranges(spark):
    # A third of the rows share one key: they must not all fall into one range.
    rows = [(7, f"text number {i}") for i in range(300)] + [(1000 + i, f"other {i}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = fingerprints.compare_neighbours(docs).collect()
    assert len(found) == 900 and sum(1 for r in found if r.doc_id == 7) == 300
    hot = docs.select(F.col("doc_id").alias("key"), "text").repartitionByRange(4, F.desc("key"), "text")
    assert max(hot.rdd.glom().map(len).collect()) < 300

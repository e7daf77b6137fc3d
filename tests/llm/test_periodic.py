"""Periodic runs against their definition, checked one stretch at a time."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from pagesieve.llm import periodic
from pagesieve.llm.queries import op12_periodic_runs, planted


def runs_by_hand(words, min_length=6, exponent=4):
    n, found = len(words), set()
    for q in range(1, n + 1):
        k = q
        while k < n:
            if words[k] != words[k - q]:
                k += 1
                continue
            s = k
            while k < n and words[k] == words[k - q]:
                k += 1
            start, end = s - q, k - 1
            length = end - start + 1
            if length >= max(min_length, exponent * q):
                stretch = words[start : end + 1]
                smallest = next(p for p in range(1, q + 1) if all(stretch[i] == stretch[i - p] for i in range(p, length)))
                if smallest == q:
                    found.add((start, length, q))
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed_by_hand(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def ids(words):
    names = {}
    return np.array([names.setdefault(w, len(names)) for w in words], dtype=np.int64)


@pytest.mark.parametrize("seed", range(40))
def test_runs_match_the_definition(seed):
    rng = random.Random(seed)
    words = []
    while len(words) < rng.randint(0, 120):
        if rng.random() < 0.3:
            unit = [rng.choice("abc") for _ in range(rng.randint(1, 5))]
            words += unit * rng.randint(1, 7) + unit[: rng.randint(0, len(unit))]
        else:
            words.append(rng.choice("abcdef"))
    runs = periodic.runs_of(ids(words))
    assert runs == runs_by_hand(words)
    assert periodic.collapsed(words, runs) == collapsed_by_hand(words, runs)


def test_one_word_filling_a_long_text():
    words = ["a"] * 5000
    assert periodic.runs_of(ids(words)) == [(0, 5000, 1)]
    assert periodic.collapsed(words, [(0, 5000, 1)]) == "a"


def test_short_empty_and_no_runs():
    assert periodic.runs_of(ids([])) == []
    assert periodic.runs_of(ids(list("aaaaa"))) == []
    assert periodic.runs_of(ids(list("aaaaaa"))) == [(0, 6, 1)]
    assert periodic.runs_of(ids(list("abababa"))) == []  # 7 < 4 * 2
    assert periodic.runs_of(ids(list("abababab"))) == [(0, 8, 2)]


def planted_by_hand(words, doc_id):
    n = len(words)
    if doc_id is None or n == 0:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(7)
    rows = []
    for doc_id in range(300):
        words = [rng.choice(["x", "y", "z", "w", "v", "u"]) for _ in range(rng.randint(0, 60))]
        rows.append((doc_id, "\t ".join(words) if rng.random() < 0.5 else " ".join(words)))
    rows += [(None, None), (301, ""), (302, "   "), (5, "a a a a a a a"), (5, "a a a a a a a")]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
    got = {(r["doc_id"], r["collapsed_sha256"]): r for r in op12_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(got) == len(set((d, t) for d, t in rows)) - 1 or len(got) >= 300
    for doc_id, text in rows:
        words = planted_by_hand(text.split() if text else [], doc_id)
        runs = runs_by_hand(words)
        digest = hashlib.sha256(collapsed_by_hand(words, runs).encode()).hexdigest()
        row = got[(doc_id, digest)]
        assert row["n_runs"] == len(runs)
        listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        assert row["runs_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        if runs:
            best = min(runs, key=lambda r: (-r[1], r[0], r[2]))
            assert (row["start"], row["length"], row["period"]) == best
            assert row["exponent_milli"] == 1000 * best[1] // best[2]
        else:
            assert (row["start"], row["length"], row["period"], row["exponent_milli"]) == (None,) * 4


def test_planting_in_sql_functions(spark):
    from pyspark.sql import functions as F

    rows = [(i, [f"w{j}" for j in range(i % 37)]) for i in range(400)] + [(None, ["a"])]
    df = spark.createDataFrame(rows, "doc_id long, words array<string>")
    got = df.select("doc_id", planted(F.col("words"), F.col("doc_id")).alias("p")).collect()
    assert sum(1 for i, w in rows if w and i is not None and zlib.crc32(str(i).encode()) % 10 == 0) > 10
    for row in got:
        assert row["p"] == planted_by_hand(dict(rows)[row["doc_id"]], row["doc_id"])

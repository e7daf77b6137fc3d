"""Mixing sources to target weights, against the definition worked out by hand."""

import math

import duckdb
import numpy as np
import pytest

from pagesieve.llm import mixing
from pagesieve.llm.oracles import ORACLES

SCHEMA = "doc_id long, text string, source string, lang string"


def by_hand(rows, weights=(5, 2, 1), cap=3.0):
    """Targets by water-filling: cap the source whose cap is smallest against its weight, again."""
    sizes = {}
    for _, text, source, *_ in rows:
        sizes[source] = sizes.get(source, 0) + (len(text.split()) if text else 0)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, free, targets = sum(sizes.values()), set(order), {}
    while True:
        left = total - sum(targets.values())
        share = sum(weight[s] for s in free)
        over = [s for s in free if share and left * weight[s] / share >= cap * sizes[s]]
        if not over:
            break
        for s in over:
            targets[s] = cap * sizes[s]
            free.discard(s)
    for s in free:
        targets[s] = left * weight[s] / share
    return sizes, weight, targets


def mixed(spark, rows, **extra):
    df = spark.createDataFrame(rows, SCHEMA)
    for name, value in extra.items():
        df = df.withColumn(name, value)
    return mixing.mix_documents(df).collect()


def check_mix(spark, rows):
    sizes, weight, targets = by_hand(rows)
    got = mixed(spark, rows)
    assert len(got) == len(rows)
    largest = {}
    for _, text, source, *_ in rows:
        largest[source] = max(largest.get(source, 0), len(text.split()) if text else 0)
    taken = {}
    for row in got:
        assert row["source_size"] == sizes[row["source"]]
        assert row["weight"] == weight[row["source"]]
        assert row["target"] == pytest.approx(targets[row["source"]], rel=1e-12, abs=1e-9)
        assert 0 <= row["taken"] <= 3 * row["size"]
        taken[row["source"]] = taken.get(row["source"], 0) + row["taken"]
    for source, words in taken.items():
        assert abs(words - targets[source]) <= largest[source] / 2 + 1e-9
    return got


def test_caps_bind_and_excess_is_shared_again(spark):
    rows = [(i, "w " * (1 + i % 4), "a", "en") for i in range(40)]  # weight 5, small
    rows += [(100 + i, "w " * 7, "b", "en") for i in range(60)]  # weight 2
    rows += [(200 + i, "w " * 9, "c", "en") for i in range(80)]  # weight 1
    got = check_mix(spark, rows)
    rates = {row["source"]: row["rate"] for row in got}
    assert rates["a"] == 3.0 and rates["b"] < 3.0


def test_nulls_empty_texts_and_a_hot_source(spark):
    rows = [(i, "x y z " * (i % 7), "hot", None) for i in range(600)]
    rows += [(None, None, "hot", None), (None, "", None, None), (7, "one two", None, "de"), (7, "one two", None, "de")]
    rows += [(900 + i, "p q", "cold", "fr") for i in range(5)]
    got = check_mix(spark, rows)
    assert sum(row["source"] is None for row in got) == 3


def test_reruns_agree_and_extra_columns_do_not_clash(spark):
    from pyspark.sql import functions as F

    rows = [(i, "a b c " * (i % 5), f"s{i % 4}", "en") for i in range(100)]
    first = sorted(mixed(spark, rows))
    again = sorted(mixed(spark, rows, size=F.lit("clash"), target=F.lit(1), taken=F.lit(None)))
    assert first == again


def test_empty_table(spark):
    assert mixed(spark, []) == []


def test_sql_agrees(spark, tmp_path):
    rows = [(i, "w " * (1 + i % 9), ["a", "b", "c", None][i % 4], "en") for i in range(120)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    theirs = sorted(db.execute(f"SELECT doc_id, copies, target FROM ({ORACLES['op11_source_mixing']})").fetchall())
    ours = sorted((r["doc_id"], r["copies"], r["target"]) for r in mixed(spark, rows))
    assert ours == theirs


def balanced_by_hand(sizes, sources, targets):
    """Entropy balancing over documents: base rates 1, a multiplier per source, damped Newton
    steps with the whole Hessian."""
    names = sorted(targets, key=str)
    held = np.array([[size * (source == name) for name in names] for size, source in zip(sizes, sources, strict=True)], float)
    member = (held > 0).astype(float)
    goal, weight = np.array([targets[name] for name in names]), np.array(sizes, float)
    lam = np.zeros(len(names))

    def dual(at):
        return weight @ np.exp(member @ at) - goal @ at

    for _ in range(200):
        rates = np.exp(member @ lam)
        step = np.linalg.solve(member.T @ (member * (weight * rates)[:, None]), goal - held.T @ rates)
        scale = 1.0
        while dual(lam + scale * step) > dual(lam) and scale > 1e-9:
            scale /= 2
        lam = lam + scale * step
    return dict(zip(names, lam, strict=True)), np.exp(member @ lam)


def test_each_source_has_its_multiplier_over_equal_base_rates(spark):
    rows = [(i, "w " * (1 + i % 4), "a", "en") for i in range(40)]
    rows += [(100 + i, "w " * (2 + i % 3), "b", "en") for i in range(60)]
    rows += [(200 + i, "w " * 9, "c", "en") for i in range(80)]
    rows += [(300 + i, "w " * (1 + i % 2), None, "en") for i in range(9)]
    got = sorted(mixed(spark, rows), key=lambda row: row["doc_id"])
    multipliers, rates = balanced_by_hand([r["size"] for r in got], [r["source"] for r in got], {r["source"]: r["target"] for r in got})
    assert len({round(m, 6) for m in multipliers.values()}) > 2
    for row, rate in zip(got, rates, strict=True):
        assert row["multiplier"] == pytest.approx(multipliers[row["source"]], abs=1e-9)
        assert row["rate"] == pytest.approx(rate, rel=1e-9)


def test_balance_reaches_far_targets_and_says_when_it_does_not(spark):
    far = [("cap", 10, 30.0), ("one", 7, 7.0), ("tiny", 10**15, 1.0), ("none", 5, 0.0), (None, 0, 0.0)]
    sources = spark.createDataFrame(far, "source string, source_size long, target double")
    got = {row["source"]: row for row in mixing.balance(sources, 3.0).collect()}
    assert [got[name]["rate"] for name in ("cap", "one", "none", None)] == [3.0, 1.0, 0.0, 0.0]
    assert got["tiny"]["multiplier"] == pytest.approx(math.log(1e-15), abs=1e-9)
    assert got["none"]["multiplier"] is None
    with pytest.raises(Exception, match="not balanced: tiny"):
        mixing.balance(sources, 3.0, steps=5).collect()

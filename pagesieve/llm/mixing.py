"""Mixing sources to target weights by entropy balancing, in DataFrame functions only.

Targets come first: the words of the corpus shared by weight, no source above ``cap`` times its
size (``share_words``). Then the mix gives every document a rate, the expected number of its
copies. Of all rates that take each source's target, it chooses those nearest, by relative entropy
weighed with each document's size, to base rates ``q_d``, the one copy that the corpus holds:

    minimise  sum_d size_d * (r_d * log(r_d / q_d) - r_d + q_d),  q_d = 1
    such that sum_(d in s) size_d * r_d = target_s  for each source s,  0 <= r_d <= cap.

The dual has one multiplier per constraint; rates are tilted base rates, ``q_d * e**lam_s``. Its
gradient in ``lam_s`` is the target less the words taken, its Hessian the words taken, diagonal
since a document has one source; so Newton's step on all multipliers at once is a step of each
alone, ``(target - taken) / taken``, and all steps of a source are made in its row. Documents are
counted into the table of sources once, before: under equal base rates a source takes its size
times ``e**lam_s``. From ``log(cap)``, where no root lies above, the steps come down to the root
and never pass it, since the words taken are convex in the multiplier. What ``exp`` leaves open in
the last bits is closed on the rate itself, in which the constraint is linear, so that whole rates
are whole.

The rate is then rounded into whole copies: ``floor(rate)`` of every document, one more of those
that a sweep in a fixed hashed order meets while the source still lacks words, judged at each
document's middle. The sweep is a prefix sum over (source, block of the hash), then within blocks,
so that a source holding a third of the rows is spread over as many tasks as there are blocks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagesieve.session import stored

#: Characters that end a word; a word is a run of any others.
BLANKS = r"\x20\x09-\x0D"
#: Hex digits of the order key that name its block: 16**3 blocks a source.
BLOCK_DIGITS = 3
#: Newton steps on a multiplier: one for each power of ``e`` that its rate lies below the cap, and
#: about six to settle; enough for rates down to ``cap * e**-50``.
STEPS = 56
#: Part of its target by which a source's words may miss it once the steps are made.
BALANCED = 1e-9


@dataclass(frozen=True)
class Mix:
    #: Weights of the sources in code-point order of their names (null last), repeating.
    weights: tuple[int, ...] = (5, 2, 1)
    #: No document is taken more than this many times.
    cap: float = 3.0


def word_count(text: Column) -> Column:
    """Words of ``text``: runs of characters other than blanks; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{BLANKS}]+")), F.lit(0)).cast("long")


def order_key(doc_id: Column, text: Column) -> Column:
    """A fixed pseudo-random order of documents: the MD5 hex of id and text."""
    return F.md5(F.concat_ws("\x00", F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit(""))))


def source_ranks(sources: DataFrame) -> DataFrame:
    """``sources`` (one row per source) with its 1-based place ``rank`` in code-point order,
    null last. Ranges of sources are numbered in tasks of their own and shifted by the sizes of
    the ranges before them, so no task holds all sources."""
    parts = max(1, int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = sources.repartitionByRange(parts, F.col("source").isNull(), "source").withColumn(
        "part", F.spark_partition_id()
    )
    local = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").isNull(), "source"))
    sized = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = sized.select(
        "part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before")
    )
    return ordered.withColumn("local", local).join(before, "part").select(
        *[name for name in sources.columns], (F.col("before") + F.col("local")).alias("rank")
    )


def share_words(sources: DataFrame, total: int, cap: float) -> float:
    """Words ``mu`` for each unit of weight, so that targets ``min(cap * size, weight * mu)`` of the
    table ``sources`` (size, weight) sum up to ``total``.

    A source is capped when ``weight * mu >= cap * size``. Each step sums, in one aggregation,
    the sizes of capped sources and the weights of the others, and shares among these what those
    leave; it stops when the set of capped sources no longer changes.
    """
    if total == 0:
        return 0.0
    weights = sources.agg(F.sum("weight")).first()[0]
    mu, seen = total / weights, None
    while True:
        capped = F.col("weight") * F.lit(mu) >= F.lit(cap) * F.col("size")
        row = sources.agg(
            F.sum(F.when(capped, F.col("size")).otherwise(0)).alias("capped_size"),
            F.sum(F.when(capped, 0).otherwise(F.col("weight"))).alias("free_weight"),
        ).first()
        state = (int(row["capped_size"]), int(row["free_weight"]))
        if state == seen or state[1] == 0:
            return mu
        seen = state
        mu = (total - cap * state[0]) / state[1]


def balance(sources: DataFrame, cap: float, steps: int = STEPS) -> DataFrame:
    """``sources`` (source_size, target) with the dual's ``multiplier`` of each source and the
    ``rate`` of its documents.

    A source without target takes nothing: its rate is 0 and its multiplier null. A target that
    the steps do not reach is an error.
    """
    target, size = F.col("target"), F.col("source_size")

    def newton(multiplier: Column, _: Column) -> Column:
        taken = size * F.exp(multiplier)
        return multiplier + (target - taken) / taken

    found = F.reduce(F.sequence(F.lit(1), F.lit(steps)), F.lit(math.log(cap)), newton)
    balanced = sources.withColumn("multiplier", F.when(target > 0, found))
    rate = F.least(F.lit(cap), F.exp("multiplier"))
    missed = F.raise_error(F.concat(F.lit("not balanced: "), F.coalesce("source", F.lit("null")))).cast("double")
    met = F.abs(size * rate - target) <= F.lit(BALANCED) * target
    return balanced.withColumn("rate", F.when(target <= 0, F.lit(0.0)).when(met, target / size).otherwise(missed))


def mix_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``doc_id, source, size, source_size, weight, target, multiplier, rate, copies, taken`` per
    document.

    ``size`` counts words (null text: 0). Sources in code-point order of their names, null last
    (its own source), get ``mix.weights`` in turn; targets share all words by weight, none above
    ``mix.cap`` times its source, the excess shared again by weight. ``multiplier`` and ``rate``
    balance the sources to their targets (``balance``). ``copies`` is
    ``floor(rate)`` or one more, ``taken = copies * size``; a source's taken words differ from its
    target by at most half its largest document, and no document is taken more than ``cap``
    times. Equal rows (same id and text) get the same order place, so which of them is taken once
    more is not fixed, but the rows given back are. A null ``doc_id`` is a document like any
    other. Extra columns of ``docs`` are not carried. An empty table gives no rows.
    Runs a few small jobs while it is built (the source table, a total and the shares).
    """
    spark = docs.sparkSession
    sized = stored(
        docs.select(
            "doc_id",
            "source",
            word_count(F.col("text")).alias("size"),
            order_key(F.col("doc_id"), F.col("text")).alias("order"),
        ),
        "mix-sizes",
    )
    per_source = sized.groupBy("source").agg(F.sum("size").alias("size"))
    choose = F.element_at(F.array(*map(F.lit, mix.weights)), (F.pmod(F.col("rank") - 1, F.lit(len(mix.weights))) + 1).cast("int"))
    sources = stored(source_ranks(per_source).withColumn("weight", choose.cast("long")), "mix-sources")
    total = sources.agg(F.sum("size")).first()[0] or 0
    mu = share_words(sources, int(total), mix.cap)
    target = F.least(F.lit(mix.cap) * F.col("size"), F.lit(mu) * F.col("weight"))
    sources = balance(sources.select("source", F.col("size").alias("source_size"), "weight", target.alias("target")), mix.cap)
    # What the whole copies leave open, in words: the budget of the sweep.
    sources = sources.withColumn("budget", F.col("target") - F.floor("rate") * F.col("source_size"))

    blocked = sized.withColumn("block", F.substring("order", 1, BLOCK_DIGITS))
    blocks = blocked.groupBy("source", "block").agg(F.sum("size").alias("block_size"))
    earlier = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("source", "block", F.coalesce(F.sum("block_size").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source", "block").orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    swept = blocked.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    swept = swept.join(blocks, swept["source"].eqNullSafe(blocks["source"]) & (swept["block"] == blocks["block"])).select(
        swept["doc_id"], swept["source"], "size", "order", (F.col("inside") + F.col("offset")).alias("before")
    )
    placed = swept.join(sources, swept["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    extra = (F.lit(2.0) * F.col("before") + F.col("size") < F.lit(2.0) * F.col("budget")).cast("long")
    copies = F.floor("rate").cast("long") + extra
    return placed.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "weight",
        "target",
        "multiplier",
        "rate",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )

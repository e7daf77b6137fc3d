"""Scoring: a scorer adds ``classes`` and ``probabilities`` to every row it gets."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesieve.functions.domains import top_domain
from pagesieve.functions.paths import archive_path, drop_first_slash
from pagesieve.functions.scores import chosen_class, chosen_probability, linear_probabilities
from pagesieve.operators.clean import Cleaning, clean_text
from pagesieve.operators.features import join_features, page_features
from pagesieve.session import stored
from pagesieve.sources.files import as_uri, dealt, fetch_snapshots
from pagesieve.sources.pages import sample_rows
from pagesieve.sources.results import copy_files, write_scores_csv

Scorer = Callable[[DataFrame], DataFrame]
Predictor = Callable[[pd.DataFrame], np.ndarray]


def _with_classes(df: DataFrame, probabilities: Column) -> DataFrame:
    return df.withColumn("probabilities", probabilities).withColumn(
        "classes", chosen_class(F.col("probabilities"))
    )


def linear_scorer(weights: Mapping[str, float], bias: float) -> Scorer:
    """A fixed linear model over numeric columns."""
    return lambda df: _with_classes(df, linear_probabilities(weights, bias))


def pipeline_scorer(model: PipelineModel) -> Scorer:
    """A trained or loaded Spark ML pipeline."""

    def score(df: DataFrame) -> DataFrame:
        scored = model.transform(df).withColumn("_p", vector_to_array("probability"))
        return _with_classes(scored.select(*df.columns, "_p"), F.col("_p")).drop("_p")

    return score


def batch_scorer(load_predictor: Callable[[], Predictor], inputs: list[str]) -> Scorer:
    """Any Python model. ``load_predictor`` runs once per task; the predictor it returns gets the
    ``inputs`` of one Arrow batch and gives one row of two probabilities for each.

    Only the inputs travel to Python, and each prediction comes back to the row it belongs to.
    """

    @F.pandas_udf("array<double>")
    def probabilities(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        predict = load_predictor()
        for batch in batches:
            yield pd.Series(list(np.asarray(predict(batch), dtype="float64")))

    # The filter on the class must not be pushed below the model, which would then run twice.
    once = probabilities.asNondeterministic()
    return lambda df: _with_classes(df, once(F.struct(*inputs)))


def decode(scored: DataFrame) -> DataFrame:
    """Replace both probabilities by the chosen class's ``probability``."""
    chosen = chosen_probability(F.col("probabilities"), F.col("classes"))
    return scored.withColumn("probability", chosen).drop("probabilities")


def keep_positives(scored: DataFrame, name: str) -> DataFrame:
    """Rows of class 1, with its probability as ``name``."""
    return decode(scored.where("classes = 1")).drop("classes").withColumnRenamed("probability", name)


def cascade(df: DataFrame, main: Scorer, sub: Scorer | None = None) -> DataFrame:
    """Positives of ``main``, as ``logits``; or of both, as ``logits_main`` and ``logits_sub``.

    The second model only sees rows the first one kept, and both use the words prepared once.
    """
    if sub is None:
        return keep_positives(main(df), "logits")
    return keep_positives(sub(keep_positives(main(df), "logits_main")), "logits_sub")


# Names of the result table's columns.
RESULT_NAMES = {
    "website_name": "wzmc",
    "domain": "ym",
    "top_domain": "yjym",
    "file_path": "nwdz",
    "process_time": "rksj",
}
RESULT_ORDER = ["wzmc", "ym", "yjym", "url", "nwdz", "rksj"]


def result_rows(positives: DataFrame, archive_root: str, processed_at: Column) -> DataFrame:
    """Positive rows as the result table holds them, pointing to their archived snapshots.

    ``offset`` stays with them, since purging goes by it.
    """
    named = (
        positives.withColumns(
            {
                "top_domain": top_domain(F.col("domain")),
                "file_path": archive_path(F.col("file_path"), archive_root, processed_at),
                "process_time": processed_at.cast("timestamp_ntz"),
            }
        )
        .withColumnsRenamed(RESULT_NAMES)
    )
    logits = [name for name in ("logits", "logits_main", "logits_sub") if name in named.columns]
    return named.select("offset", *RESULT_ORDER, *logits)


def score_pages(
    rows: DataFrame,
    snapshots: DataFrame | str,
    how: Cleaning,
    stop_words: DataFrame,
    main: Scorer,
    sub: Scorer | None = None,
    frequencies: DataFrame | None = None,
    all_snapshots: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """Positive rows of a whole job: snapshots, features, words, one or two models.

    ``rows`` have offset, website_name, domain, url and file_path; ``offset`` is unique.
    ``snapshots`` is the folder of the files the rows name, fetched one by one in ``tasks`` tasks,
    or a table of ``file_path, html``. Of a table only snapshots some row names are parsed;
    ``all_snapshots`` skips that check where every one is wanted, which spares moving their HTML.
    Rows without a snapshot are scored on empty text. Rows with their features are stored once,
    for the passes that rank and clean them.
    """
    rows = rows.withColumn("file_path", drop_first_slash(F.col("file_path")))
    parsed = {"keep": how.keep or r"\s\S", "aliases": how.aliases}
    if isinstance(snapshots, str):
        data = page_features(fetch_snapshots(rows, snapshots, tasks=tasks), **parsed)
    else:
        if not all_snapshots:
            wanted = rows.select("file_path").distinct()
            snapshots = snapshots.join(wanted, "file_path", "left_semi")
        data = join_features(rows, page_features(snapshots, **parsed), "offset")
    return cascade(clean_text(stored(data, "features"), "offset", stop_words, how, frequencies), main, sub)


def archiving(
    score: Callable[[DataFrame], DataFrame],
    source: str,
    target: str,
    archive_root: str,
    processed_at: Column,
    tasks: int | None = None,
) -> Callable[[DataFrame], DataFrame]:
    """A job for the incremental runs: score the rows, copy the positives' snapshots from below
    ``source`` to their archive paths below ``target``, then give the rows to store. ``score``
    gives positives whose ``file_path`` is relative to ``source``, as ``score_pages`` does.

    All copies are made before any row that points to one is stored, and the mark moves after
    both, so a job that breaks off anywhere is repeated: copying again overwrites. A snapshot that
    is missing keeps its row and is not copied.
    """

    def job(rows: DataFrame) -> DataFrame:
        positives = stored(score(rows), "positives")
        kept = archive_path(F.col("file_path"), archive_root, processed_at)
        pairs = positives.where("file_path is not null").select(
            F.concat(F.lit(as_uri(source) + "/"), "file_path").alias("source"),
            F.concat(F.lit(as_uri(target) + "/"), kept).alias("target"),
        )
        pairs = dealt(pairs.distinct(), tasks, "source")
        copy_files(pairs, "source", "target").write.format("noop").mode("overwrite").save()
        return result_rows(positives, archive_root, processed_at)

    return job


def score_sample(
    table: DataFrame,
    which: str,
    key: str,
    how: Cleaning,
    stop_words: DataFrame,
    model: Scorer,
    path: str,
    n: int = 100,
) -> None:
    """Score the first ``n`` rows of one class of a prepared table and write the scores as CSV."""
    columns = [key, "title", "keywords", "description", "corpus"]
    sample = sample_rows(table, which, columns, key, n)
    scored = decode(model(clean_text(sample, key, stop_words, how)))
    write_scores_csv(scored.select(key, "probability", "classes"), path)

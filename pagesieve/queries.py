"""The registered queries: every operator over the given tables, whole.

Each takes ``(spark, folder)`` and gives a DataFrame; ``oracles.py`` holds the same in SQL.
"""

from __future__ import annotations

import datetime

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesieve.functions.domains import host_of, top_domain
from pagesieve.functions.html import AttrRule, page_attr, page_title
from pagesieve.functions.paths import archive_path, basename, drop_first_slash
from pagesieve.functions.text import (
    LETTERS,
    concat_meta,
    join_words,
    keep_characters,
    letter_words,
    merge_meta,
    replace_aliases,
    restore_aliases,
    split_words,
    word_counts,
)
from pagesieve.operators.clean import Cleaning, clean_text, joined_text, letter_splitter
from pagesieve.operators.encode import META_LENGTH, encode
from pagesieve.operators.features import join_features, page_features
from pagesieve.operators.metrics import evaluate, write_metrics
from pagesieve.operators.ngrams import runs_of
from pagesieve.operators.pooling import pool_vectors, rounded, window_pool
from pagesieve.operators.segment import most_frequent, segment, weigh_common
from pagesieve.operators.skew import skew_join
from pagesieve.operators.stopwords import drop_stop_words
from pagesieve.operators.tfidf import document_frequencies, top_words, word_lists
from pagesieve.operators.vocabulary import learn_vectors, number_words, vocabulary_size, word_frequencies
from pagesieve.plans import maintenance
from pagesieve.plans.scoring import (
    archiving,
    batch_scorer,
    cascade,
    decode,
    linear_scorer,
    pipeline_scorer,
    result_rows,
    score_pages,
    score_sample,
)
from pagesieve.plans.training import load_model, save_model, train, train_vectors, with_vectors
from pagesieve.schemas import CASCADE_RESULT, RESULT
from pagesieve.session import new_folder, stored
from pagesieve.sources import files, lines, marks, pages, results
from pagesieve.sources.params import TrainingParams, read_params
from pagesieve.sources.tables import read_table
from pagesieve.streaming.batch import run_above_mark
from pagesieve.streaming.incremental import read_counts, read_frequencies, run_frequencies, run_incremental, stream_rows

STOP_WORDS = ["the", "and", "to", "in", "of", "der", "und", "la", "de", "les", "el", "en"]
ALIAS = [("and", "个贷")]
DAY = "2024-01-31 12:00:00"
ROOT = "archive/positives"
LINKS = {
    "keywords": AttrRule("href", "^/", "href"),
    "description": AttrRule("class", "", "class"),
}
BUCKETS = {"share_disk": "first-bucket", "datanfs": "second-bucket"}
PLAIN = Cleaning(letter_splitter(), costly=False, keep=None, aliases=())

# Fixed linear models. The first two read documents, the third one pages.
MAIN = ({"k_chars": 0.5, "n_words": -0.002}, -0.3)
SUB = ({"k_chars": -0.25, "n_words": 0.001}, 0.4)
SAMPLE = ({"n_tags": 0.1, "n_meta": -0.01}, 0.2)
PAGES = ({"n_title": 0.05, "n_letters": -0.0004}, -1.5)


def day() -> Column:
    return F.lit(DAY).cast("timestamp_ntz")


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return read_table(spark, folder, "documents").select("doc_id", *columns)


def web_pages(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "pages")


def words_of(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder, "text").select("doc_id", letter_words(F.col("text")).alias("words"))


def stop_list(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*map(F.lit, STOP_WORDS))).alias("word"))


# -- scans


def incremental_scan(spark, folder):
    table = read_table(spark, folder, "pages")
    rows = pages.incoming_rows(table, 0, {"page_id": "offset", "html": "file_path"})
    return rows.select("offset", "url", F.length("file_path").cast("long").alias("n_chars"))


def max_offset(spark, folder):
    return read_table(spark, folder, "pages").agg(F.max("page_id").alias("offset"))


def classified(spark, folder):
    """Documents with a label and the set they belong to, as training rows are stored."""
    labels = read_table(spark, folder, "labels").withColumnRenamed("quality", "label")
    drawn = F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1)
    table = documents(spark, folder, "text", "source", "lang", "n_chars").join(labels, "doc_id")
    return table.withColumn(
        "class", F.when(drawn.isin("0", "1", "2"), "testset").otherwise("trainset")
    )


def train_test_split(spark, folder):
    table = classified(spark, folder)
    sets = [
        pages.labelled_rows(table, which, ["doc_id", "class", "n_chars"])
        for which in ("trainset", "testset")
    ]
    return sets[0].unionByName(sets[1])


def sample_limit(spark, folder):
    table = classified(spark, folder)
    return pages.sample_rows(table, "trainset", ["doc_id", "source", "lang"], "doc_id")


def shuffle_order(spark, folder):
    return pages.shuffled_rows(read_table(spark, folder, "documents").select("doc_id"), "doc_id", 7)


# -- pages


def title_query(spark, folder):
    return web_pages(spark, folder).select("page_id", page_title(F.col("html")).alias("title"))


def attr_query(spark, folder):
    link = page_attr(F.col("html"), "href", "^/", "href")
    return web_pages(spark, folder).select("page_id", link.alias("link"))


def linked_features(spark, folder):
    return page_features(web_pages(spark, folder), LINKS, LETTERS, aliases=())


def features_query(spark, folder):
    return linked_features(spark, folder).select(
        "page_id",
        "title",
        F.col("keywords").alias("link"),
        F.col("description").alias("css_class"),
        F.length("corpus").cast("long").alias("n_letters"),
    )


def feature_left_join(spark, folder):
    """Pages with no own link have no features here, those with a markup sign in the title two."""
    table = web_pages(spark, folder)
    features = page_features(table.withColumnRenamed("url", "file_path"), LINKS, LETTERS, aliases=())
    features = stored(features.select("file_path", "title", "keywords"), "fields")
    features = features.where("keywords is not null")
    doubled = features.unionByName(features.where(F.col("title").contains("&")))
    rows = table.select("page_id", F.col("url").alias("file_path"))
    return join_features(rows, doubled, "page_id").select("page_id", "file_path", "title", "keywords")


def meta_concat(spark, folder):
    fields = [F.col(name) for name in ("title", "keywords", "description")]
    return linked_features(spark, folder).select(
        "page_id", concat_meta(*fields).alias("meta"), merge_meta(*fields).alias("merged")
    )


# -- text


def script_filter(spark, folder):
    table = documents(spark, folder, "text")
    return table.select("doc_id", keep_characters(F.col("text"), LETTERS).alias("letters"))


def alias_replace(spark, folder):
    table = documents(spark, folder, "text")
    aliased = keep_characters(replace_aliases(F.col("text"), ALIAS), LETTERS).alias("aliased")
    return table.select("doc_id", aliased).withColumn("restored", restore_aliases(F.col("aliased"), ALIAS))


def stopword_filter(spark, folder):
    """The stop words come from a text file."""
    path = new_folder(spark, "stop-words")
    stop_list(spark).write.text(path)
    listed = lines.read_stop_words(spark, path)
    kept = drop_stop_words(words_of(spark, folder), "doc_id", ["words"], listed)
    return kept.select("doc_id", join_words(F.col("words")).alias("kept"))


def stopword_join(spark, folder):
    """As ``stopword_filter``, the way longer stop lists take."""
    kept = drop_stop_words(words_of(spark, folder), "doc_id", ["words"], stop_list(spark), in_row_words=0, piece_rows=1000)
    return kept.select("doc_id", join_words(F.col("words")).alias("kept"))


def tfidf_topk(spark, folder):
    return top_words(words_of(spark, folder), "doc_id", "words")


def tfidf_known(spark, folder):
    """Ranked by stored frequencies, here those of the labelled documents alone."""
    words = words_of(spark, folder)
    labelled = read_table(spark, folder, "labels").select("doc_id")
    known = document_frequencies(words.join(labelled, "doc_id", "left_semi"), "words")
    return top_words(words, "doc_id", "words", known)


def as_features(table: DataFrame, *others: str) -> DataFrame:
    names = {"title": "source", "keywords": "lang", "description": "text", "corpus": "text"}
    return table.select("doc_id", *others, *(F.col(column).alias(name) for name, column in names.items()))


def clean_query(spark, folder):
    table = as_features(documents(spark, folder, "text", "source", "lang"))
    cleaned = clean_text(table, "doc_id", stop_list(spark), PLAIN)
    return joined_text(cleaned, ()).select("doc_id", "tag_words", "meta_words")


def cut_weights(spark, folder):
    """Texts without their spaces, cut again by the words of the corpus: the weight of the cut and
    of the words that were there, and whether the pieces give the text again."""
    words = words_of(spark, folder)
    dictionary = stored(word_frequencies(words, "words"), "dictionary")
    unspaced = words.select("doc_id", F.array_join("words", "").alias("text"))
    cut = segment(unspaced, "doc_id", {"text": "cut"}, dictionary)
    rebuilt = F.array_join("cut", "") == F.col("text")
    lists = cut.select("doc_id", F.lit("cut").alias("of"), rebuilt.alias("rebuilt"), F.col("cut").alias("words")).unionByName(
        words.select("doc_id", F.lit("words").alias("of"), F.lit(None).cast("boolean").alias("rebuilt"), "words")
    )
    n_words = dictionary.agg(F.sum("freq")).scalar()
    weight = F.ln(F.col("freq") / n_words).alias("weight")
    # Common words are weighed where they are; the others meet their weights in a join.
    found = stored(weigh_common(lists, "words", most_frequent(dictionary).select("word", weight)), "cut")
    counted = found.select("doc_id", "of", F.explode(word_counts(F.col("words"))).alias("entry"))
    pieces = counted.select("doc_id", "of", "entry.word", "entry.tf")
    weighed = skew_join(pieces, dictionary.select("word", weight), "word", spread=[F.col("doc_id")])
    weight = F.coalesce("weight", -F.ln(n_words)) * F.col("tf")  # characters that are no word
    every = found.select("doc_id", "of", "rebuilt", F.col("common_weight").alias("weight")).unionByName(
        weighed.select("doc_id", "of", F.lit(None).cast("boolean").alias("rebuilt"), weight.alias("weight"))
    )

    def total(of):
        return F.sum(F.when(F.col("of") == of, F.col("weight")))

    return every.groupBy("doc_id").agg(
        F.max("rebuilt").alias("rebuilt"), total("cut").alias("weight"), total("words").alias("spaced_weight")
    )


def segment_text(spark, folder):
    """No text is cut worse than its own words cut it."""
    return cut_weights(spark, folder).select(
        "doc_id",
        F.round(F.coalesce("spaced_weight", F.lit(0.0)), 4).alias("spaced_weight"),
        F.coalesce("rebuilt", F.lit(True)).alias("rebuilt"),
        F.coalesce(F.col("weight") > F.col("spaced_weight") - 1e-6, F.lit(True)).alias("no_worse"),
    )


# -- vocabulary and encoding


def vocab_build(spark, folder):
    return number_words(word_frequencies(words_of(spark, folder), "words"))


def vocab_count(spark, folder):
    frequencies = word_frequencies(words_of(spark, folder), "words")
    return vocabulary_size(frequencies).select((F.col("n_words") + 1).alias("n_words"))


def vocab_size_file(spark, folder):
    """The vocabulary's size, written as a text file and read again."""
    path = new_folder(spark, "vocabulary-size")
    lines.write_vocabulary_size(vocab_build(spark, folder), path)
    return spark.read.text(path).select(F.col("value").cast("long").alias("n_words"))


def split_again(spark, folder):
    """Word lists joined to one text, as records store them, and split again."""
    again = split_words(join_words(F.col("words")))
    return words_of(spark, folder).select(
        "doc_id", F.size(again).cast("long").alias("n_words"), F.array_join(again, ",").alias("words")
    )


def vocab_files(spark, folder):
    """The vocabulary written as a word list and read again: ids are line numbers."""
    path = new_folder(spark, "vocabulary")
    lines.write_vocabulary(vocab_build(spark, folder), path)
    return lines.read_vocabulary(spark, path)


def embeddings(spark, folder):
    """Vectors by vocabulary id: the first one belongs to id 1."""
    return read_table(spark, folder, "embeddings").select(
        (F.col("vec_id") + 1).alias("id"), F.col("embedding").alias("vector")
    )


def word_vectors(spark, folder):
    """Vectors of the most frequent words, through a word-vector text file."""
    named = vocab_build(spark, folder).join(embeddings(spark, folder), "id")
    path = new_folder(spark, "vectors")
    lines.write_vectors(named.select("word", "id", "vector"), path)
    return lines.read_vectors(spark, path).select(
        "word", "id", F.posexplode("vector").alias("pos", "value")
    ).select("word", "id", "pos", F.round(F.col("value").cast("double"), 6).alias("value"))


def learned_vectors(spark, folder):
    """Vectors learned from all documents' words, written as a word-vector text file and read
    again: every vocabulary word seen five times or more, with its vocabulary id."""
    words = words_of(spark, folder)
    vocabulary = number_words(word_frequencies(words, "words"))
    learned = learn_vectors(words, "words", vocabulary, size=64, min_count=5, window=5, seed=42, partitions=4)
    path = new_folder(spark, "learned")
    lines.write_vectors(learned.select("word", "id", "vector"), path)
    back = lines.read_vectors(spark, path)
    return back.select("word", "id", F.size("vector").cast("long").alias("n_dims"))


def encoded(spark, folder, vocabulary):
    words = words_of(spark, folder)
    ranked = top_words(words, "doc_id", "words")
    tags = word_lists(ranked, "doc_id", "rank", "tag_words")
    # Cut before the join: records keep no more of the list, so no more of it is shuffled.
    first = words.select("doc_id", F.slice("words", 1, META_LENGTH).alias("meta_words"))
    both = first.join(tags, "doc_id", "left")
    return encode(both, "doc_id", vocabulary)


def encode_pad(spark, folder):
    ids = encoded(spark, folder, vocab_build(spark, folder))
    return ids.select("doc_id", *(F.array_join(F.col(name).cast("array<string>"), ",").alias(name) for name in ("text", "meta")))


def ngram_features(spark, folder):
    """Runs of the lengths that a parameter file names."""
    path = new_folder(spark, "params")
    spark.range(1).select(F.lit("1, 2,3").alias("filter_sizes")).write.json(path)
    tags = word_lists(tfidf_topk(spark, folder), "doc_id")
    return runs_of(tags, "doc_id", "words", read_params(spark, path).filter_sizes)


def embedding_pool(spark, folder):
    vocabulary = vocab_build(spark, folder)
    ids = encoded(spark, folder, vocabulary)
    every = ids.select("doc_id", F.concat("text", "meta").alias("ids"))
    pooled = pool_vectors(
        every,
        "doc_id",
        "ids",
        embeddings(spark, folder),
        vocabulary.select("id", "freq"),
        "freq",
    )
    both = F.arrays_zip(
        rounded(vector_to_array("max_vector"), 6).alias("max_v"),
        rounded(vector_to_array("mean_vector"), 6).alias("mean_v"),
    )
    return pooled.select("doc_id", F.posexplode(both).alias("pos", "v")).select(
        "doc_id", "pos", "v.max_v", "v.mean_v"
    )


def window_pooling(spark, folder):
    """Every document's rank-ordered top words, pooled over windows of 1, 2 and 3 known words."""
    vocabulary = vocab_build(spark, folder)
    ids = encoded(spark, folder, vocabulary)
    pooled = window_pool(ids, "doc_id", "text", embeddings(spark, folder), (1, 2, 3), vocabulary.select("id", "freq"), "freq")
    return pooled.select("doc_id", F.posexplode("pooled").alias("pos", "value")).select(
        "doc_id", "pos", F.round("value", 6).alias("value")
    )


# -- scoring


def measured(table: DataFrame) -> DataFrame:
    """What the fixed models read: thousands of characters, and words."""
    return table.withColumns(
        {
            "k_chars": F.col("n_chars") / 1000.0,
            "n_words": F.size(letter_words(F.col("text"))),
        }
    ).drop("text")


def scored_documents(spark, folder):
    return decode(linear_scorer(*MAIN)(measured(documents(spark, folder, "text", "n_chars"))))


def predict_positive(spark, folder):
    probability = F.round("probability", 9).alias("probability")
    return scored_documents(spark, folder).where("classes = 1").select("doc_id", "classes", probability)


def score_batches(spark, folder):
    """The same model as a Python predictor, loaded once per task."""
    weights, bias = MAIN

    def load():
        def predict(batch):
            logit = bias + sum(batch[name] * weight for name, weight in weights.items())
            positive = 1.0 / (1.0 + np.exp(-logit))
            return np.column_stack([1.0 - positive, positive])

        return predict

    table = measured(documents(spark, folder, "text", "n_chars"))
    scored = decode(batch_scorer(load, list(weights))(table))
    return scored.select("doc_id", "classes", F.round("probability", 9).alias("probability"))


def cascade_query(spark, folder):
    table = measured(documents(spark, folder, "text", "n_chars"))
    both = cascade(table, linear_scorer(*MAIN), linear_scorer(*SUB))
    return both.select(
        "doc_id", *(F.round(name, 9).alias(name) for name in ("logits_main", "logits_sub"))
    )


def eval_metrics(spark, folder):
    scored = linear_scorer(*MAIN)(measured(classified(spark, folder)))
    quality = evaluate(scored)
    return quality.select("n_rows", *(F.round(name, 6).alias(name) for name in quality.columns[1:]))


def metrics_file(spark, folder):
    """The metrics as a JSON file of doubles, read again."""
    path = new_folder(spark, "metrics")
    write_metrics(eval_metrics(spark, folder), path)
    return spark.read.json(path)


def csv_roundtrip(spark, folder):
    path = new_folder(spark, "scores")
    scores = scored_documents(spark, folder).select("doc_id", "classes", "probability")
    results.write_scores_csv(scores, path)
    back = results.read_scores_csv(spark, path, scores.schema)
    return back.withColumn("probability", F.round("probability", 9))


def train_classifier(spark, folder):
    """Train, save, load, and evaluate on the rows held out: is it better than always the larger class?"""
    table = as_features(classified(spark, folder), "label", "class")
    prepared = clean_text(table, "doc_id", stop_list(spark), PLAIN)
    prepared = stored(prepared.select("doc_id", "tag_words", "meta_words", "label", "class"), "prepared")
    params = TrainingParams(l2_reg_lambda=0.01, num_epochs=20, num_features=1 << 14)
    columns = ["doc_id", "tag_words", "meta_words"]
    path = new_folder(spark, "model")
    save_model(train(pages.labelled_rows(prepared, "trainset", columns), params), path)
    held_out = pages.labelled_rows(prepared, "testset", columns)
    quality = evaluate(pipeline_scorer(load_model(path))(held_out))
    beats = (F.col("accuracy") > F.col("majority")).alias("beats_majority")
    return quality.select("n_rows", F.round("majority", 6).alias("majority"), beats)


def vector_features(spark, folder, keys: DataFrame) -> DataFrame:
    """``doc_id, pooled, meta_mean`` of the documents in ``keys``: the top words pooled over
    windows of 1, 2 and 3 (``window_pooling``), and the mean vector of the first words."""
    vocabulary = vocab_build(spark, folder)
    ids = encoded(spark, folder, vocabulary).join(keys, "doc_id", "left_semi")
    vectors, counts = embeddings(spark, folder), vocabulary.select("id", "freq")
    pooled = window_pool(ids, "doc_id", "text", vectors, (1, 2, 3), counts, "freq")
    meta = pool_vectors(ids, "doc_id", "meta", vectors, counts, "freq")
    meta = meta.select("doc_id", vector_to_array("mean_vector").alias("meta_mean"))
    # How much of each list the vocabulary knows: unknown words have no vector to pool.
    known = lambda name: F.size(F.filter(name, lambda word: word > 0)).cast("double")
    shares = ids.select(
        "doc_id",
        F.array(
            known("text") / F.greatest(F.size("text"), F.lit(1)),
            known("meta") / F.greatest(F.size("meta"), F.lit(1)),
            F.log1p(known("text")),
            F.log1p(known("meta")),
        ).alias("coverage"),
    )
    return keys.join(pooled, "doc_id", "left").join(meta, "doc_id", "left").join(shares, "doc_id", "left")


def vector_classifier(spark, folder):
    """A network on pooled word vectors, trained, saved and loaded, against the majority class on
    the rows held out."""
    table = classified(spark, folder).select("doc_id", "label", "class")
    features = stored(vector_features(spark, folder, table), "vector-features")
    width = read_table(spark, folder, "embeddings").select(F.max(F.size("embedding"))).first()[0] or 0
    inputs = {"pooled": 3 * width, "meta_mean": width, "coverage": 4}
    model = train_vectors(pages.labelled_rows(features, "trainset", ["doc_id", *inputs]), inputs, hidden=8, epochs=40)
    held_out = with_vectors(pages.labelled_rows(features, "testset", ["doc_id", *inputs]), inputs)
    scored = pipeline_scorer(model)(held_out)
    whole = (F.abs(F.aggregate("probabilities", F.lit(0.0), lambda a, b: a + b) - 1) < 1e-9).cast("int")
    quality = evaluate(scored).crossJoin(scored.agg(F.sum(whole).cast("long").alias("n_scored")))
    # Accuracy and loss are in evaluate's row too; SQL cannot train, so they are left out here.
    return quality.select("n_rows", F.round("majority", 6).alias("majority"), "n_scored")


def sample_scores(spark, folder):
    """The first rows of the test set, scored into a CSV file and read again."""
    counts = {"n_tags": F.size("tag_words"), "n_meta": F.size("meta_words")}

    def score(df):
        return linear_scorer(*SAMPLE)(df.withColumns(counts)).drop(*counts)

    path = new_folder(spark, "sample")
    table = as_features(classified(spark, folder), "label", "class")
    score_sample(table, "testset", "doc_id", PLAIN, stop_list(spark), score, path)
    schema = T.StructType.fromDDL("doc_id long, probability double, classes int")
    back = results.read_scores_csv(spark, path, schema)
    return back.withColumn("probability", F.round("probability", 9))


def model_reload(spark, folder):
    """A model saved and loaded scores every labelled document as the one in memory does."""
    words = words_of(spark, folder).select(
        "doc_id", F.slice("words", 1, 20).alias("tag_words"), F.slice("words", 21, 60).alias("meta_words")
    )
    labels = read_table(spark, folder, "labels").select("doc_id", F.col("quality").cast("int").alias("label"))
    rows = words.join(labels, "doc_id")
    model = train(rows, TrainingParams([1], 0.01, 3, 1 << 10))
    path = new_folder(spark, "model")
    save_model(model, path)
    both = pipeline_scorer(model)(rows).withColumnRenamed("classes", "before")
    both = both.withColumnRenamed("probabilities", "p_before")
    again = pipeline_scorer(load_model(path))(both)
    same = (F.col("classes") == F.col("before")) & (F.col("probabilities") == F.col("p_before"))
    return again.select("doc_id", same.alias("same"))


# -- results


def page_rows(spark, folder):
    """Pages as rows of the incoming table, their HTML still with them."""
    name = F.concat(F.col("page_id").cast("string"), F.lit(".html"))
    disk = F.when(F.col("url").startswith("https"), "/share_disk/").otherwise("/datanfs/")
    return web_pages(spark, folder).select(
        F.col("page_id").alias("offset"),
        host_of(F.col("url")).alias("website_name"),
        host_of(F.col("url")).alias("domain"),
        "url",
        F.concat(disk, F.lit("snapshots/"), name).alias("file_path"),
        "html",
    )


def positive_pages(rows: DataFrame) -> DataFrame:
    """Positive rows under the fixed model, from the HTML each row carries."""
    features = page_features(rows, {}, LETTERS, aliases=())
    read = features.withColumns(
        {"n_title": F.coalesce(F.length("title"), F.lit(0)), "n_letters": F.length("corpus")}
    )
    return cascade(read.drop("corpus"), linear_scorer(*PAGES))


def result_of(rows: DataFrame) -> DataFrame:
    return result_rows(positive_pages(rows), ROOT, day())


def shown(result: DataFrame) -> DataFrame:
    return result.select(*RESULT.fieldNames()).withColumn("logits", F.round("logits", 9))


def positive_projection(spark, folder):
    return shown(result_of(page_rows(spark, folder)))


def append_query(spark, folder):
    """Two runs append to one table; every row is there twice."""
    path = new_folder(spark, "appended")
    rows = stored(result_of(page_rows(spark, folder)), "positives")
    results.append_result(rows, path)
    results.append_result(rows, path)
    return shown(results.read_result(spark, path, RESULT))


def domain_query(spark, folder):
    """Hosts, also as names below every kind of suffix."""
    host = host_of(F.col("url"))
    variants = F.array(
        host,
        F.concat(host, F.lit(".com.cn")),
        F.concat(F.lit("www."), F.substring_index(host, ".", 1), F.lit(".gov.cn")),
        F.substring_index(host, ".", 1),
        F.concat(F.lit("."), F.substring_index(host, ".", -1)),
    )
    names = read_table(spark, folder, "pages").select("page_id", F.posexplode(variants).alias("variant", "domain"))
    return names.withColumn("top_domain", top_domain(F.col("domain")))


def path_rewrite(spark, folder):
    path = drop_first_slash(F.col("file_path"))
    return page_rows(spark, folder).select(
        "offset",
        path.alias("file_path"),
        drop_first_slash(path).alias("again"),
        basename(path).alias("name"),
        archive_path(path, ROOT, day()).alias("dst"),
    )


def bucket_map(spark, folder):
    rows = page_rows(spark, folder).withColumn("file_path", drop_first_slash(F.col("file_path")))
    return results.with_bucket(rows, "file_path", BUCKETS).select("offset", "file_path", "bucket")


def archive_positives(spark, folder):
    """Positives' snapshots moved into their day's partition, by a run that is repeated, read back."""
    rows = page_rows(spark, folder)
    path = new_folder(spark, "archive")
    positives = stored(positive_pages(rows).select("offset", "file_path"), "positives")
    snapshots = rows.select("file_path", "html")
    moved = results.archived(positives, snapshots, ROOT, day(), "offset")
    for _ in range(2):
        results.write_archive(moved, path, "first")
    back = spark.read.option("basePath", path).parquet(path)
    return back.select(
        "offset", "dst", F.date_format("dt", "yyyy-MM-dd").alias("dt"),
        F.length("html").cast("long").alias("n_chars"),
    )


def staged_html() -> Column:
    """The page with meta tags: its host as keywords, the words of its URL as description. Pages
    of secure hosts get no description."""
    words = F.regexp_replace("url", "[^A-Za-z]+", " ")
    described = F.concat(F.lit('<meta name="description" content="'), words, F.lit('">'))
    tags = F.concat(
        F.lit('<head><meta name="keywords" content="'),
        host_of(F.col("url")),
        F.lit('">'),
        F.when(F.col("url").startswith("https"), "").otherwise(described),
    )
    return F.replace(F.col("html"), F.lit("<head>"), tags)


def snapshot_read(spark, folder):
    """Snapshots fetched by name from a store of files. Those of URLs with a mark are not there,
    those of mobile hosts not in UTF-8."""
    store = new_folder(spark, "store")
    rows = page_rows(spark, folder).withColumn("file_path", drop_first_slash(F.col("file_path")))
    content = F.when(F.col("website_name").startswith("m."), F.encode("html", "UTF-16"))
    there = rows.where(~F.col("url").contains("#")).select(
        "file_path", content.otherwise(F.encode("html", "UTF-8")).alias("content")
    )
    files.store_snapshots(there, store).write.format("noop").mode("overwrite").save()
    found = files.fetch_snapshots(rows.select("offset", "file_path"), store, tasks=8)
    return found.select("offset", F.length("html").cast("long").alias("n_chars"), F.md5("html").alias("digest"))


JOB_MODELS = ({"n_tags": 0.1, "n_rare": 0.2}, -3.0), ({"n_meta": 0.3, "n_rare": -0.3}, 0.1)


def score_job(spark, folder):
    """The whole cascade job over a table: snapshots fetched by name, features, words, two models,
    positives' snapshots archived, rows stored, mark moved. ``n_archived`` is the length of the
    file a stored row points to."""
    stage = Stage(spark, "job")
    store, archive = f"{stage.root}/store", f"{stage.root}/archive"
    staged = page_rows(spark, folder).withColumn("content", staged_html())
    relative = drop_first_slash(F.col("file_path"))
    content = staged.select(relative.alias("file_path"), "content")
    files.store_snapshots(content, store).write.format("noop").mode("overwrite").save()

    def counting(model):
        def score(df):
            counts = {
                "n_tags": F.size("tag_words"),
                "n_rare": F.size(F.filter("tag_words", lambda word: F.length(word) > 8)),
                "n_meta": F.size("meta_words"),
            }
            return linear_scorer(*model)(df.withColumns(counts)).drop(*counts)

        return score

    main, sub = map(counting, JOB_MODELS)

    def score(rows):
        return score_pages(rows, store, PLAIN, stop_list(spark), main, sub, tasks=8)

    table = staged.drop("html", "content").withColumnsRenamed(
        {"offset": "id", "website_name": "sname", "file_path": "snapshot"}
    )
    job = archiving(score, store, archive, ROOT, day(), tasks=8)
    for _ in range(2):  # the second run finds nothing new
        run_above_mark(table, job, stage.result, stage.marks)
    kept = results.read_result(spark, stage.result, CASCADE_RESULT)
    kept = files.fetch_snapshots(kept, archive, "nwdz", "copy", tasks=8)
    return kept.withColumn("n_archived", F.length("copy").cast("long")).drop("copy").withColumns(
        {name: F.round(name, 9) for name in ("logits_main", "logits_sub")}
    )


def backup_purge(spark, folder):
    """Back up a result table, purge it at a mark, reset the saved offset."""
    place = new_folder(spark, "tables")
    table, saved = f"result_{place[-32:]}", f"{place}/marks"
    rows = read_table(spark, folder, "pages").select(F.col("page_id").alias("offset"), "url")
    maintenance.save_table(rows, table, place)
    mark = rows.agg(F.expr("max(offset) div 2").alias("mark")).first()["mark"]
    marks.write_mark(spark, saved, mark)
    copy = maintenance.maintain(
        spark, table, saved, marks.read_mark(spark, saved), datetime.date(2024, 1, 31), place
    )
    kept = spark.table(table).select("offset", F.lit(True).alias("kept"))
    return spark.table(copy).join(kept, "offset", "left").select(
        "offset", "url", F.coalesce("kept", F.lit(False)).alias("kept"),
        F.lit(marks.read_mark(spark, saved)).cast("long").alias("mark"),
    )


# -- incremental jobs. Their input is staged first: rows arrive as files, or lie in a table.


class Stage:
    """One incremental job's folders."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = new_folder(spark, name)
        self.rows, self.result, self.marks = (f"{self.root}/{part}" for part in ("rows", "result", "marks"))

    def arrive(self, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(self.rows)

    def run(self, schema, checkpoint: str = "checkpoint", files: int = 4) -> None:
        stream = stream_rows(self.spark, self.rows, schema, files)
        run_incremental(stream, result_of, self.result, self.marks, f"{self.root}/{checkpoint}")

    def forget_last_commit(self, checkpoint: str = "checkpoint") -> None:
        """Leave the checkpoint as a crash before its last commit would."""
        jvm, context = self.spark._jvm, self.spark.sparkContext
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{checkpoint}/commits")
        files = folder.getFileSystem(context._jsc.hadoopConfiguration())
        done = [status.getPath() for status in files.listStatus(folder)]
        files.delete(max(done, key=lambda path: int(path.getName()) if path.getName().isdigit() else -1), False)

    def outcome(self) -> DataFrame:
        mark = F.lit(marks.read_mark(self.spark, self.marks)).cast("long")
        return shown(results.read_result(self.spark, self.result, RESULT)).withColumn("mark", mark)


def stream_incremental(spark, folder):
    rows = page_rows(spark, folder)
    stage = Stage(spark, "stream")
    stage.arrive(rows)
    stage.run(rows.schema)
    return stage.outcome()


def stage_counts(spark, folder):
    """The stream job's counts of rows read and positives stored, summed over its batches, and the
    largest offset: each batch read once."""
    rows = page_rows(spark, folder)
    stage = Stage(spark, "counted")
    stage.arrive(rows)
    stage.run(rows.schema)
    counts = read_counts(spark, stage.marks)
    return counts.agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_positives").alias("n_positives"), F.max("largest").alias("largest")
    )


def stream_frequencies(spark, folder):
    """Document frequencies kept across the batches of a stream of documents, the last batch
    replayed after a crash before its commit: equal to those over all documents at once."""
    docs = documents(spark, folder, "text")
    stage = Stage(spark, "frequencies")
    # Rows arrive as several files, so that the stream sees several batches.
    stage.arrive(docs.repartition(8, "doc_id"))
    stream = stream_rows(spark, stage.rows, docs.schema, 2)
    counted = f"{stage.root}/frequencies"

    def words(batch):
        return batch.select(letter_words(F.col("text")).alias("words"))

    run_frequencies(stream, words, counted, f"{stage.root}/checkpoint")
    stage.forget_last_commit()
    run_frequencies(stream_rows(spark, stage.rows, docs.schema, 2), words, counted, f"{stage.root}/checkpoint")
    return read_frequencies(spark, counted)


def stream_resume(spark, folder):
    """One part arrives and is handled; the rest arrives later and is all the next run handles."""
    rows = page_rows(spark, folder)
    stage = Stage(spark, "resume")
    secure = F.col("url").startswith("https")
    for part in (secure, ~secure):
        stage.arrive(rows.where(part))
        stage.run(rows.schema)
    return stage.outcome()


def stream_replay(spark, folder):
    """The last batch is handled twice, as after a crash between result and checkpoint."""
    rows = page_rows(spark, folder)
    stage = Stage(spark, "replay")
    secure = F.col("url").startswith("https")
    for part in (secure, ~secure):
        stage.arrive(rows.where(part))
        stage.run(rows.schema, files=1)
    stage.forget_last_commit()
    stage.run(rows.schema, files=1)
    return stage.outcome()


def stream_new_checkpoint(spark, folder):
    """Two queries with checkpoints and sources of their own share one result."""
    rows = page_rows(spark, folder)
    stage = Stage(spark, "shared")
    secure = F.col("url").startswith("https")
    for part, source, files in ((secure, "first", 1), (~secure, "second", 3)):
        stage.rows = f"{stage.root}/{source}-rows"
        stage.arrive(rows.where(part))
        stage.run(rows.schema, source, files)
    return stage.outcome()


def batch_incremental(spark, folder):
    """The job over a table: the first run handles what is there, the second finds nothing new."""
    stage = Stage(spark, "batch")
    table = page_rows(spark, folder).withColumnsRenamed(
        {"offset": "id", "website_name": "sname", "file_path": "snapshot"}
    )
    first, second = (run_above_mark(table, result_of, stage.result, stage.marks) for _ in range(2))
    return stage.outcome().withColumns(
        {"n_first": F.lit(first).cast("long"), "n_second": F.lit(second).cast("long")}
    )


def reset_resume(spark, folder):
    """A run over the table, the mark set back, a run over the pages that came since: all stay."""
    stage = Stage(spark, "reset")
    table = page_rows(spark, folder).withColumnsRenamed(
        {"offset": "id", "website_name": "sname", "file_path": "snapshot"}
    )
    secure = F.col("url").startswith("https")
    run_above_mark(table.where(secure), result_of, stage.result, stage.marks)
    marks.reset_mark(spark, stage.marks)
    run_above_mark(table.where(~secure), result_of, stage.result, stage.marks)
    return shown(results.read_result(spark, stage.result, RESULT))


def job_upkeep(spark, folder):
    """The job into a catalog table; that table backed up, purged below half the mark, the mark set
    back; then a run over the pages that came since."""
    place = new_folder(spark, "upkeep")
    name, saved = f"positives_{place[-32:]}", f"{place}/marks"
    sink = maintenance.table_sink(name, place)
    table = page_rows(spark, folder).withColumnsRenamed(
        {"offset": "id", "website_name": "sname", "file_path": "snapshot"}
    )
    secure = F.col("url").startswith("https")
    run_above_mark(table.where(secure), result_of, sink, saved)
    half = marks.read_mark(spark, saved) // 2
    copy = maintenance.maintain(spark, name, saved, half, datetime.date(2024, 1, 31), place)
    run_above_mark(table.where(~secure), result_of, sink, saved)
    both = [shown(spark.table(of)).withColumn("place", F.lit(what)) for of, what in ((copy, "backup"), (name, "table"))]
    return both[0].unionByName(both[1])


QUERIES = {
    "incremental_scan": incremental_scan,
    "max_offset": max_offset,
    "train_test_split": train_test_split,
    "sample_limit": sample_limit,
    "shuffle_order": shuffle_order,
    "page_title": title_query,
    "page_attr": attr_query,
    "page_features": features_query,
    "feature_left_join": feature_left_join,
    "meta_concat": meta_concat,
    "script_filter": script_filter,
    "alias_replace": alias_replace,
    "stopword_filter": stopword_filter,
    "stopword_join": stopword_join,
    "tfidf_topk": tfidf_topk,
    "tfidf_known": tfidf_known,
    "clean_text": clean_query,
    "segment_text": segment_text,
    "vocab_build": vocab_build,
    "vocab_count": vocab_count,
    "vocab_size_file": vocab_size_file,
    "split_words": split_again,
    "vocab_files": vocab_files,
    "word_vectors": word_vectors,
    "encode_pad": encode_pad,
    "ngram_features": ngram_features,
    "embedding_pool": embedding_pool,
    "window_pooling": window_pooling,
    "learned_vectors": learned_vectors,
    "predict_positive": predict_positive,
    "score_batches": score_batches,
    "cascade": cascade_query,
    "eval_metrics": eval_metrics,
    "metrics_file": metrics_file,
    "csv_roundtrip": csv_roundtrip,
    "model_reload": model_reload,
    "sample_scores": sample_scores,
    "train_classifier": train_classifier,
    "vector_classifier": vector_classifier,
    "positive_projection": positive_projection,
    "append_result": append_query,
    "top_domain": domain_query,
    "path_rewrite": path_rewrite,
    "bucket_map": bucket_map,
    "archive_positives": archive_positives,
    "snapshot_read": snapshot_read,
    "score_job": score_job,
    "backup_purge": backup_purge,
    "stream_incremental": stream_incremental,
    "stream_resume": stream_resume,
    "stage_counts": stage_counts,
    "stream_frequencies": stream_frequencies,
    "stream_replay": stream_replay,
    "stream_new_checkpoint": stream_new_checkpoint,
    "batch_incremental": batch_incremental,
    "reset_resume": reset_resume,
    "job_upkeep": job_upkeep,
}

"""The registered queries in DuckDB's SQL, each over the same tables in full."""

from __future__ import annotations

from pagesieve.queries import ALIAS, BUCKETS, DAY, JOB_MODELS, MAIN, PAGES, ROOT, SAMPLE, STOP_WORDS, SUB

# Patterns
NO_LETTER = r"[^\p{L}]"
STOPS = ", ".join(f"'{word}'" for word in STOP_WORDS)

# Documents and their words
WORDS = f"""
docs AS (
  SELECT doc_id, text, source, lang, n_chars,
         list_filter(string_split_regex(lower(text), '{NO_LETTER}+'), lambda w: length(w) >= 2) AS words
  FROM documents)"""
ALL_WORDS = "all_words AS (SELECT doc_id, len(words) AS n_words, unnest(words) AS word FROM docs)"
COUNTED = "counted AS (SELECT doc_id, n_words, word, count(*) AS tf FROM all_words GROUP BY ALL)"


def _ranked(frequencies: str, n_docs: str, join: str = "JOIN") -> str:
    """Top words by ``frequencies(word, df)``."""
    return f"""
scored AS (
  SELECT doc_id, word, tf,
         round(tf::DOUBLE / n_words * ln((1.0 + ({n_docs})::DOUBLE) / (1.0 + coalesce(df, 0)::DOUBLE)), 9) AS score
  FROM counted {join} ({frequencies}) USING (word)),
ranked AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, word) AS rank, word, tf, score
  FROM scored QUALIFY rank <= 20)"""


TOP = f"""{WORDS}, {ALL_WORDS}, {COUNTED}, {_ranked(
    "SELECT word, count(*) AS df FROM counted GROUP BY word", "SELECT count(*) FROM docs")}"""
TAGS = "tags AS (SELECT doc_id, list(word ORDER BY rank) AS tag_words FROM ranked GROUP BY doc_id)"

VOCABULARY = """
freqs AS (SELECT word, count(*) AS freq FROM all_words GROUP BY word),
vocabulary AS (
  SELECT '</s>' AS word, 0 AS id, 0 AS freq
  UNION ALL
  SELECT word, row_number() OVER (ORDER BY freq DESC, word) AS id, freq FROM freqs)"""

ENCODED = f"""{TOP}, {TAGS}, {VOCABULARY},
lists AS (
  SELECT doc_id, list_slice(coalesce(tag_words, []), 1, 20) AS text, list_slice(words, 1, 80) AS meta
  FROM docs LEFT JOIN tags USING (doc_id)),
entries AS (
  SELECT doc_id, 'text' AS part, unnest(text) AS word, generate_subscripts(text, 1) AS place FROM lists
  UNION ALL
  SELECT doc_id, 'meta', unnest(meta), generate_subscripts(meta, 1) FROM lists),
found AS (
  SELECT doc_id, part, place, coalesce(id, 0) AS id FROM entries LEFT JOIN vocabulary USING (word)),
ids AS (
  SELECT doc_id,
         list(id ORDER BY place) FILTER (part = 'text') AS text,
         list(id ORDER BY place) FILTER (part = 'meta') AS meta
  FROM found GROUP BY doc_id)"""


def _padded(name: str, length: int) -> str:
    zeros = ", ".join(["0"] * length)
    return f"array_to_string(list_slice(list_concat(coalesce({name}, []), [{zeros}]), 1, {length}), ',') AS {name.split('.')[-1]}"


# Pages and their fields
UNESCAPED = "nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '')"
for entity, character in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("#x27", "''")):
    UNESCAPED = f"replace({UNESCAPED}, '&{entity};', '{character}')"
TITLE = f"regexp_replace({UNESCAPED}, '&amp;?', '&', 'g')"
LINK = """nullif(regexp_extract(html, '<a [^>]*href="(/[^"]*)"', 1), '')"""
CSS = """nullif(regexp_extract(html, ' class="([^"]*)"', 1), '')"""
LETTER_TEXT = f"regexp_replace(html, '{NO_LETTER}', '', 'g')"
URL_WORDS = "regexp_replace(url, '[^A-Za-z]+', ' ', 'g')"
HOST = "regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)"
FIELDS = f"""
fields AS (
  SELECT page_id, url, {TITLE} AS title, {LINK} AS keywords, {CSS} AS description, {LETTER_TEXT} AS letters
  FROM pages)"""


def _positive(model: tuple, columns: dict[str, str]) -> str:
    """Probability of class 1 under a fixed linear model."""
    weights, bias = model
    logit = f"({bias})::DOUBLE"
    for name, weight in weights.items():
        logit += f" + ({columns[name]})::DOUBLE * ({weight})::DOUBLE"
    return f"(1.0::DOUBLE / (1.0::DOUBLE + exp(-({logit}))))"


DOCUMENT = {"k_chars": "n_chars / 1000.0::DOUBLE", "n_words": "len(words)"}
P_MAIN, P_SUB = _positive(MAIN, DOCUMENT), _positive(SUB, DOCUMENT)
P_SAMPLE = _positive(SAMPLE, {"n_tags": "n_tags", "n_meta": "n_meta"})
P_PAGE = _positive(PAGES, {"n_title": "coalesce(length(title), 0)", "n_letters": "length(letters)"})
SCORED = f"{WORDS}, scored_docs AS (SELECT *, {P_MAIN} AS p FROM docs)"
CLASSIFIED = """
classified AS (
  SELECT *, quality AS label,
         CASE WHEN substring(md5(doc_id::VARCHAR), 1, 1) IN ('0', '1', '2') THEN 'testset' ELSE 'trainset' END AS class
  FROM docs JOIN labels USING (doc_id))"""

FILE_PATH = """(CASE WHEN starts_with(url, 'https') THEN 'share_disk/' ELSE 'datanfs/' END
  || 'snapshots/' || page_id::VARCHAR || '.html')"""
DST = f"'{ROOT}/{DAY[:10]}/' || page_id::VARCHAR || '.html'"
LAST_TWO = r"regexp_extract({0}, '[^.]*\.?[^.]*$')"
# No host here ends in a suffix of two labels.
TOP_OF_HOST = LAST_TWO.format(HOST)
RESULT = f"""
result AS (
  SELECT page_id AS "offset", {HOST} AS wzmc, {HOST} AS ym, {TOP_OF_HOST} AS yjym, url, {DST} AS nwdz,
         TIMESTAMP '{DAY}' AS rksj, round({P_PAGE}, 9) AS logits
  FROM fields WHERE {P_PAGE} > 0.5)"""
MARKED = f'WITH {FIELDS}, {RESULT} SELECT *, (SELECT max(page_id) FROM pages) AS mark FROM result'

STAGED = f"""replace(html, '<head>', '<head><meta name="keywords" content="' || {HOST} || '">'
  || CASE WHEN starts_with(url, 'https') THEN '' ELSE '<meta name="description" content="' || {URL_WORDS} || '">' END)"""
PAGE_TOP = f"""
{FIELDS},
docs AS (
  SELECT page_id AS doc_id,
         list_filter(string_split_regex(lower({STAGED}), '{NO_LETTER}+'), lambda w: length(w) >= 2) AS words
  FROM pages WHERE page_id > 0),
{ALL_WORDS}, {COUNTED}, {_ranked(
    "SELECT word, count(*) AS df FROM counted GROUP BY word", "SELECT count(*) FROM docs")},
{TAGS},
kept_tags AS (
  SELECT doc_id, list_filter(tag_words, lambda w: w NOT IN ({STOPS})) AS kept FROM tags),
metas AS (
  SELECT page_id, list_filter(
           string_split_regex(lower(coalesce(title || {HOST} || {URL_WORDS}, '')), '{NO_LETTER}+'),
           lambda w: length(w) >= 2 AND w NOT IN ({STOPS})) AS words
  FROM fields),
measured AS (
  SELECT p.page_id, p.url, coalesce(len(kept), 0) AS n_tags,
         coalesce(len(list_filter(kept, lambda w: length(w) > 8)), 0) AS n_rare,
         CASE WHEN starts_with(p.url, 'https') THEN 0 ELSE len(m.words) END AS n_meta,
         length({STAGED}) AS n_archived
  FROM pages p LEFT JOIN kept_tags ON p.page_id = doc_id JOIN metas m ON p.page_id = m.page_id)"""
JOB_MAIN, JOB_SUB = (
    _positive(model, {name: name for name in ("n_tags", "n_rare", "n_meta")}) for model in JOB_MODELS
)


ORACLES = {
    "incremental_scan": """
        SELECT page_id AS "offset", url, length(html) AS n_chars FROM pages
        WHERE page_id > 0 AND html IS NOT NULL""",
    "max_offset": 'SELECT max(page_id) AS "offset" FROM pages',
    "train_test_split": f"WITH {WORDS}, {CLASSIFIED} SELECT doc_id, class, n_chars, label FROM classified",
    "sample_limit": f"""WITH {WORDS}, {CLASSIFIED}
        SELECT doc_id, source, lang FROM classified WHERE class = 'trainset' ORDER BY doc_id LIMIT 100""",
    "shuffle_order": "SELECT doc_id, md5('7-' || doc_id::VARCHAR) AS drawn FROM documents ORDER BY drawn, doc_id",
    "page_title": f"SELECT page_id, {TITLE} AS title FROM pages",
    "page_attr": f"SELECT page_id, {LINK} AS link FROM pages",
    "page_features": f"""WITH {FIELDS}
        SELECT page_id, title, keywords AS link, description AS css_class, length(letters) AS n_letters FROM fields""",
    "feature_left_join": f"""WITH {FIELDS},
        features AS (SELECT url AS file_path, title, keywords FROM fields WHERE keywords IS NOT NULL),
        doubled AS (SELECT * FROM features UNION ALL SELECT * FROM features WHERE contains(title, '&'))
        SELECT page_id, url AS file_path, d.title, d.keywords FROM pages LEFT JOIN doubled d ON url = d.file_path""",
    "meta_concat": f"""WITH {FIELDS}
        SELECT page_id, title || keywords || description AS meta,
               title || coalesce(keywords, 'nan') || coalesce(description, 'nan') AS merged FROM fields""",
    "script_filter": f"SELECT doc_id, regexp_replace(text, '{NO_LETTER}', '', 'g') AS letters FROM documents",
    "alias_replace": f"""
        WITH aliased AS (
          SELECT doc_id, regexp_replace(
                   regexp_replace(text, '{ALIAS[0][0]}', '{ALIAS[0][1]}', 'gi'), '{NO_LETTER}', '', 'g') AS aliased
          FROM documents)
        SELECT doc_id, aliased, replace(aliased, '{ALIAS[0][1]}', '{ALIAS[0][0]}') AS restored FROM aliased""",
    "stopword_filter": f"""WITH {WORDS}
        SELECT doc_id, array_to_string(list_filter(words, lambda w: w NOT IN ({STOPS})), ' ') AS kept FROM docs""",
    "tfidf_topk": f"WITH {TOP} SELECT doc_id, rank, word, tf, score FROM ranked",
    "tfidf_known": f"""WITH {WORDS}, {ALL_WORDS}, {COUNTED}, {_ranked(
        "SELECT word, count(*) AS df FROM counted SEMI JOIN labels USING (doc_id) GROUP BY word",
        "SELECT count(*) FROM docs SEMI JOIN labels USING (doc_id)", "LEFT JOIN")}
        SELECT doc_id, rank, word, tf, score FROM ranked""",
    "clean_text": f"""
        WITH {TOP}, {TAGS}, metas AS (
          SELECT doc_id, list_filter(
            string_split_regex(lower(source || lang || text), '{NO_LETTER}+'), lambda w: length(w) >= 2) AS words
          FROM documents)
        SELECT doc_id,
          coalesce(array_to_string(list_filter(tag_words, lambda w: w NOT IN ({STOPS})), ' '), '') AS tag_words,
          array_to_string(list_filter(words, lambda w: w NOT IN ({STOPS})), ' ') AS meta_words
        FROM metas LEFT JOIN tags USING (doc_id)""",
    "segment_text": f"""WITH {WORDS}, {ALL_WORDS}, freqs AS (SELECT word, count(*) AS freq FROM all_words GROUP BY word),
        weights AS (SELECT word, ln(freq::DOUBLE / (SELECT sum(freq) FROM freqs)::DOUBLE) AS weight FROM freqs),
        sums AS (SELECT doc_id, sum(weight) AS weight FROM all_words JOIN weights USING (word) GROUP BY doc_id)
        SELECT doc_id, round(coalesce(weight, 0), 4) AS spaced_weight, TRUE AS rebuilt, TRUE AS no_worse
        FROM docs LEFT JOIN sums USING (doc_id)""",
    "vocab_build": f"WITH {WORDS}, {ALL_WORDS}, {VOCABULARY} SELECT word, id, freq FROM vocabulary",
    "learned_vectors": f"""WITH {WORDS}, {ALL_WORDS},
        freqs AS (SELECT word, count(*) AS freq FROM all_words GROUP BY word)
        SELECT word, row_number() OVER (ORDER BY freq DESC, word) - 1 AS id,
               CAST((SELECT max(len(embedding)) FROM embeddings) AS BIGINT) AS n_dims
        FROM freqs WHERE freq >= 5""",
    "vector_classifier": f"""WITH {WORDS}, {CLASSIFIED}
        SELECT count(*) AS n_rows, round(greatest(avg(label), 1 - avg(label)), 6) AS majority, count(*) AS n_scored
        FROM classified WHERE class = 'testset'""",
    "vocab_count": f"WITH {WORDS}, {ALL_WORDS} SELECT count(DISTINCT word) + 1 AS n_words FROM all_words",
    "vocab_files": f"WITH {WORDS}, {ALL_WORDS}, {VOCABULARY} SELECT word, id FROM vocabulary",
    "word_vectors": f"""WITH {WORDS}, {ALL_WORDS}, {VOCABULARY},
        named AS (SELECT word, vec_id AS id, embedding FROM vocabulary v JOIN embeddings e ON v.id = e.vec_id + 1)
        SELECT word, id, unnest(range(len(embedding))) AS pos, round(unnest(embedding)::DOUBLE, 6) AS value
        FROM named""",
    "encode_pad": f"""WITH {ENCODED}
        SELECT doc_id, {_padded("ids.text", 20)}, {_padded("ids.meta", 80)} FROM docs LEFT JOIN ids USING (doc_id)""",
    "ngram_features": f"""WITH {TOP}, {TAGS},
        runs AS (
          SELECT doc_id, size, tag_words, unnest(range(len(tag_words) - size + 1)) AS place
          FROM tags, (VALUES (1), (2), (3)) sizes(size))
        SELECT doc_id, size, place, array_to_string(list_slice(tag_words, place + 1, place + size), ' ') AS gram
        FROM runs""",
    "embedding_pool": f"""WITH {ENCODED},
        vectors AS (
          SELECT doc_id, unnest(range(len(embedding))) AS pos, unnest(embedding)::DOUBLE AS value
          FROM found JOIN embeddings ON id = vec_id + 1)
        SELECT doc_id, pos, round(max(value), 6) AS max_v, round(avg(value), 6) AS mean_v
        FROM vectors GROUP BY doc_id, pos""",
    "window_pooling": f"""WITH {ENCODED},
        known AS (
          SELECT doc_id, place, embedding FROM found JOIN embeddings ON id = vec_id + 1 WHERE part = 'text'),
        numbered AS (
          SELECT doc_id, embedding, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS r,
                 count(*) OVER (PARTITION BY doc_id) AS n FROM known),
        slots AS (
          SELECT doc_id, r, n, unnest(range(len(embedding))) AS dim, unnest(embedding)::DOUBLE AS value FROM numbered),
        windows AS (
          SELECT a.doc_id, s.k, a.r, a.dim, sum(b.value) / count(*) AS mean
          FROM slots a, (VALUES (1), (2), (3)) s(k), slots b
          WHERE b.doc_id = a.doc_id AND b.dim = a.dim AND b.r >= a.r AND b.r < a.r + s.k
            AND (a.r + s.k - 1 <= a.n OR (a.r = 1 AND a.n < s.k))
          GROUP BY a.doc_id, s.k, a.r, a.dim)
        SELECT doc_id, CAST((k - 1) * (SELECT max(len(embedding)) FROM embeddings) + dim AS INT) AS pos, round(max(mean), 6) AS value
        FROM windows GROUP BY doc_id, k, dim""",
    "predict_positive": f"""WITH {SCORED}
        SELECT doc_id, 1 AS classes, round(p, 9) AS probability FROM scored_docs WHERE p > 0.5""",
    "score_batches": f"""WITH {SCORED}
        SELECT doc_id, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS classes, round(greatest(p, 1 - p), 9) AS probability
        FROM scored_docs""",
    "cascade": f"""WITH {SCORED}, both_models AS (SELECT *, {P_SUB} AS q FROM scored_docs)
        SELECT doc_id, round(p, 9) AS logits_main, round(q, 9) AS logits_sub FROM both_models
        WHERE p > 0.5 AND q > 0.5""",
    "eval_metrics": f"""WITH {WORDS}, {CLASSIFIED},
        scored AS (SELECT label, {P_MAIN} AS p, CASE WHEN {P_MAIN} > 0.5 THEN 1 ELSE 0 END AS guess FROM classified)
        SELECT count(*) AS n_rows,
          round(avg((label = guess)::INT), 6) AS accuracy,
          round(coalesce(sum((label = 1 AND guess = 1)::INT) / nullif(sum((guess = 1)::INT), 0), 0), 6) AS precision,
          round(coalesce(sum((label = 1 AND guess = 1)::INT) / nullif(sum((label = 1)::INT), 0), 0), 6) AS recall,
          round(avg(-ln(CASE label WHEN 1 THEN p ELSE 1 - p END)), 6) AS loss,
          round(greatest(avg(label), 1 - avg(label)), 6) AS majority
        FROM scored""",
    "positive_projection": f"WITH {FIELDS}, {RESULT} SELECT * FROM result",
    "append_result": f"WITH {FIELDS}, {RESULT} SELECT * FROM result UNION ALL SELECT * FROM result",
    "top_domain": f"""
        WITH hosts AS (SELECT page_id, {HOST} AS host FROM pages),
        labels_of AS (
          SELECT page_id, host, string_split(host, '.')[1] AS head, string_split(host, '.')[-1] AS tail FROM hosts)
        SELECT page_id, 0 AS variant, host AS domain, {LAST_TWO.format("host")} AS top_domain FROM labels_of
        UNION ALL SELECT page_id, 1, host || '.com.cn', tail || '.com.cn' FROM labels_of
        UNION ALL SELECT page_id, 2, 'www.' || head || '.gov.cn', head || '.gov.cn' FROM labels_of
        UNION ALL SELECT page_id, 3, head, head FROM labels_of
        UNION ALL SELECT page_id, 4, '.' || tail, tail FROM labels_of""",
    "path_rewrite": f"""
        SELECT page_id AS "offset", {FILE_PATH} AS file_path, regexp_replace({FILE_PATH}, '/', '') AS again,
               page_id::VARCHAR || '.html' AS name, {DST} AS dst FROM pages""",
    "bucket_map": f"""
        SELECT page_id AS "offset", {FILE_PATH} AS file_path, bucket
        FROM pages LEFT JOIN (VALUES {", ".join(f"('{key}', '{value}')" for key, value in BUCKETS.items())})
             buckets(segment, bucket) ON string_split({FILE_PATH}, '/')[1] = segment""",
    "archive_positives": f"""WITH {FIELDS}, {RESULT}
        SELECT "offset", nwdz AS dst, '{DAY[:10]}' AS dt, length(html) AS n_chars
        FROM result JOIN pages ON "offset" = page_id""",
    "snapshot_read": f"""
        WITH found AS (
          SELECT page_id, CASE WHEN NOT contains(url, '#') AND NOT starts_with({HOST}, 'm.') THEN html END AS html
          FROM pages)
        SELECT page_id AS "offset", length(html) AS n_chars, md5(html) AS digest FROM found""",
    "score_job": f"""WITH {PAGE_TOP}
        SELECT page_id AS "offset", {HOST} AS wzmc, {HOST} AS ym, {TOP_OF_HOST} AS yjym, url, {DST} AS nwdz,
               TIMESTAMP '{DAY}' AS rksj, round({JOB_MAIN}, 9) AS logits_main, round({JOB_SUB}, 9) AS logits_sub,
               n_archived
        FROM measured WHERE page_id > 0 AND {JOB_MAIN} > 0.5 AND {JOB_SUB} > 0.5""",
    "backup_purge": """
        SELECT page_id AS "offset", url, page_id >= (SELECT max(page_id) // 2 FROM pages) AS kept, 0 AS mark
        FROM pages""",
    "stream_incremental": MARKED,
    "stream_resume": MARKED,
    "stream_frequencies": f"""WITH {WORDS}, {ALL_WORDS}
        SELECT word, count(DISTINCT doc_id) AS df FROM all_words GROUP BY word""",
    "stage_counts": f"""WITH {FIELDS}, {RESULT}
        SELECT (SELECT count(*) FROM pages) AS n_rows, (SELECT count(*) FROM result) AS n_positives,
               (SELECT max(page_id) FROM pages) AS largest""",
    "stream_replay": MARKED,
    "stream_new_checkpoint": MARKED,
    "reset_resume": f"WITH {FIELDS}, {RESULT} SELECT * FROM result WHERE \"offset\" > 0",
    "batch_incremental": f"""WITH {FIELDS}, {RESULT}
        SELECT *, (SELECT max(page_id) FROM pages) AS mark, count(*) OVER () AS n_first, 0 AS n_second
        FROM result WHERE "offset" > 0""",
    "job_upkeep": f"""WITH {FIELDS}, {RESULT},
        secure AS (SELECT max(page_id) // 2 AS half FROM pages WHERE page_id > 0 AND starts_with(url, 'https'))
        SELECT *, 'backup' AS place FROM result WHERE "offset" > 0 AND starts_with(url, 'https')
        UNION ALL
        SELECT result.*, 'table' FROM result, secure
        WHERE "offset" > 0 AND ("offset" >= half OR NOT starts_with(url, 'https'))""",
    "train_classifier": f"""WITH {WORDS}, {CLASSIFIED}
        SELECT count(*) AS n_rows, round(greatest(avg(label), 1 - avg(label)), 6) AS majority, TRUE AS beats_majority
        FROM classified WHERE class = 'testset'""",
    "sample_scores": f"""WITH {WORDS.replace("docs AS", "every AS")}, {CLASSIFIED.replace("FROM docs", "FROM every")},
        docs AS (SELECT * FROM classified WHERE class = 'testset' ORDER BY doc_id LIMIT 100),
        {ALL_WORDS}, {COUNTED}, {_ranked(
            "SELECT word, count(*) AS df FROM counted GROUP BY word", "SELECT count(*) FROM docs")}, {TAGS},
        sizes AS (
          SELECT doc_id, coalesce(len(list_filter(tag_words, lambda w: w NOT IN ({STOPS}))), 0) AS n_tags,
            coalesce(len(list_filter(
              string_split_regex(lower(source || lang || text), '{NO_LETTER}+'),
              lambda w: length(w) >= 2 AND w NOT IN ({STOPS}))), 0) AS n_meta
          FROM docs LEFT JOIN tags USING (doc_id)),
        scored_docs AS (SELECT doc_id, {P_SAMPLE} AS p FROM sizes)
        SELECT doc_id, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS classes, round(greatest(p, 1 - p), 9) AS probability
        FROM scored_docs""",
    "split_words": f"WITH {WORDS} SELECT doc_id, len(words) AS n_words, array_to_string(words, ',') AS words FROM docs",
    "model_reload": "SELECT doc_id, TRUE AS same FROM documents SEMI JOIN labels USING (doc_id)",
}
ORACLES["stopword_join"] = ORACLES["stopword_filter"]
ORACLES["csv_roundtrip"] = ORACLES["score_batches"]
ORACLES["vocab_size_file"] = ORACLES["vocab_count"]
ORACLES["metrics_file"] = f"SELECT * REPLACE (n_rows::DOUBLE AS n_rows) FROM ({ORACLES['eval_metrics']})"

"""Queries over sources, sets and derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens import vocab
from forumlens.functions import categories, lexicon, scores, text, time
from forumlens.operators import authors, engagement, overlap, quality, trips
from forumlens.plans.registry import query
from forumlens.sources import ingest, readers, sample_tables as st


def _names(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


# --- sources ---------------------------------------------------------------------------------


@query(
    "ingest_filtered",
    f"""WITH {{posts}}
    SELECT data_type, id, subreddit, author, score, created_utc, date,
           strftime(ts, '%Y-%m') AS year_month,
           length(coalesce(body, title)) AS text_chars
    FROM posts WHERE subreddit IN ({_names(vocab.INGEST_COMMUNITIES)})""",
)
def ingest_filtered(spark: SparkSession, sf: str) -> DataFrame:
    both = readers.unify(
        ingest.filtered(st.comments(spark, sf), "comments"), ingest.filtered(st.submissions(spark, sf), "submissions")
    )
    return both.select(
        "data_type", "id", "subreddit", "author", "score", "created_utc", "date",
        time.year_month().alias("year_month"), F.length(F.coalesce("body", "title")).alias("text_chars"),
    )


@query(
    "schema_profile",
    """SELECT * FROM (
      SELECT 0 AS position, 'doc_id' AS column_name, 'bigint' AS column_type, FALSE AS interesting, count(*) AS n_rows, count(doc_id) AS non_null FROM documents
      UNION ALL SELECT 1, 'text', 'string', FALSE, count(*), count(text) FROM documents
      UNION ALL SELECT 2, 'lang', 'string', FALSE, count(*), count(lang) FROM documents
      UNION ALL SELECT 3, 'source', 'string', FALSE, count(*), count(source) FROM documents
      UNION ALL SELECT 4, 'n_chars', 'bigint', FALSE, count(*), count(n_chars) FROM documents)""",
)
def schema_profile(spark: SparkSession, sf: str) -> DataFrame:
    return readers.profile_table(st.table(spark, sf, "documents"))


@query(
    "wordlist_clean",
    r"""SELECT DISTINCT word FROM (
      SELECT lower(regexp_replace(line, '^\s+|\s+$', '', 'g')) AS word
      FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents))
    WHERE word <> '' AND NOT starts_with(word, ';')""",
)
def wordlist_clean(spark: SparkSession, sf: str) -> DataFrame:
    lines = st.table(spark, sf, "documents").select(F.explode(F.split("text", "\n")).alias("value"))
    return readers.clean_word_list(lines)


@query(
    "survey_load",
    """SELECT c_mktsegment AS benefit, round(CAST(c_acctbal AS DOUBLE), 6) AS percentage FROM customer
    WHERE c_mktsegment IS NOT NULL AND c_custkey % 7 <> 0 AND c_acctbal >= 0""",
)
def survey_load(spark: SparkSession, sf: str) -> DataFrame:
    """A sheet whose negative balances read `n/a` and whose every seventh label is missing."""
    customer = st.table(spark, sf, "customer")
    label = F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment"))
    cell = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("string")).otherwise("n/a")
    return readers.clean_survey(customer, label, cell)


@query(
    "trip_multi_scan",
    """SELECT l_linenumber AS part, 2 * count(*) AS n, round(2 * sum(l_quantity), 6) AS distance
    FROM lineitem GROUP BY ALL""",
)
def trip_multi_scan(spark: SparkSession, sf: str) -> DataFrame:
    """One scan over an explicit list of files, the same file twice."""
    files = readers.read_files(spark, [f"{sf}/lineitem.parquet", f"{sf}/lineitem.parquet"])
    return files.groupBy(F.col("l_linenumber").alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("distance")
    )


@query(
    "session_smoke",
    """SELECT count(*) AS n, sum(CAST(event_id % 2 = 0 AS BIGINT))::BIGINT AS even_rows FROM events""",
)
def session_smoke(spark: SparkSession, sf: str) -> DataFrame:
    st.table(spark, sf, "events").createOrReplaceTempView("forumlens_events")
    return spark.sql("SELECT count(*) AS n, count_if(event_id % 2 = 0) AS even_rows FROM forumlens_events")


@query(
    "sample_hash",
    """WITH {meta}
    SELECT subreddit, count(*) AS n, min(id) AS first_id, max(id) AS last_id FROM meta
    WHERE CAST('0x' || substr(md5('42:' || id), 1, 13) AS BIGINT) / 4503599627370496.0 < 0.3 GROUP BY ALL""",
)
def sample_hash(spark: SparkSession, sf: str) -> DataFrame:
    return (
        readers.sample_posts(st.posts_meta(spark, sf), 0.3)
        .groupBy("subreddit")
        .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))
    )


@query(
    "hash_split",
    """WITH {meta}
    SELECT CASE WHEN CAST('0x' || substr(md5('42:' || id), 1, 13) AS BIGINT) / 4503599627370496.0 < 0.8
                THEN 'train' ELSE 'test' END AS part,
           data_type, count(*) AS n, CAST(sum(score) AS BIGINT) AS score_sum FROM meta GROUP BY ALL""",
)
def hash_split(spark: SparkSession, sf: str) -> DataFrame:
    posts = st.posts_meta(spark, sf)
    part = F.when(scores.unit_hash(F.col("id"), 42) < 0.8, "train").otherwise("test")
    return posts.groupBy(part.alias("part"), "data_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("score").alias("score_sum")
    )


@query(
    "cap_documents",
    """SELECT doc_id, source, n_chars FROM documents
    ORDER BY CAST('0x' || substr(md5('42:' || CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT), doc_id LIMIT 500""",
)
def cap_documents(spark: SparkSession, sf: str) -> DataFrame:
    return readers.cap_documents(
        st.table(spark, sf, "documents").select("doc_id", "source", "n_chars"), 500, key="doc_id"
    )


@query(
    "first_rows",
    "WITH {meta} SELECT id, subreddit, score, created_utc FROM meta ORDER BY id, event_id LIMIT 100",
)
def first_rows(spark: SparkSession, sf: str) -> DataFrame:
    from forumlens.sources.writers import first_rows as export

    return export(st.posts_meta(spark, sf), 100, ("id", "event_id")).select("id", "subreddit", "score", "created_utc")


# --- sets ------------------------------------------------------------------------------------


@query(
    "union_positional",
    "WITH {meta} SELECT data_type, count(*) AS n, CAST(sum(score) AS BIGINT) AS score_sum FROM meta GROUP BY ALL",
)
def union_positional(spark: SparkSession, sf: str) -> DataFrame:
    meta = st.posts_meta(spark, sf)
    columns = ["data_type", "id", "subreddit", "created_utc", "score"]
    both = readers.stack(
        *[meta.where(F.col("data_type") == kind).select(*columns) for kind in ("comment", "submission")]
    )
    return both.groupBy("data_type").agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("score_sum"))


@query(
    "union_by_name",
    """WITH {posts}
    SELECT data_type, count(*) AS n, count(body) AS bodies, count(title) AS titles, count(selftext) AS selftexts,
           count(url) AS urls, count(controversiality) AS controversialities FROM posts GROUP BY ALL""",
)
def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    both = readers.unify(st.comments(spark, sf), st.submissions(spark, sf))
    return both.groupBy("data_type").agg(
        F.count(F.lit(1)).alias("n"), F.count("body").alias("bodies"), F.count("title").alias("titles"),
        F.count("selftext").alias("selftexts"), F.count("url").alias("urls"),
        F.count("controversiality").alias("controversialities"),
    )


@query("distinct_author_community", "WITH {meta} SELECT DISTINCT author, subreddit FROM meta")
def distinct_author_community(spark: SparkSession, sf: str) -> DataFrame:
    return overlap.author_communities(st.posts_meta(spark, sf))


# --- derived columns -------------------------------------------------------------------------


@query(
    "period_columns",
    """WITH {meta}
    SELECT id, created_utc, strftime(ts, '%Y-%m-%d') AS daily, strftime(ts, '%Y-%m') AS monthly,
           year(ts) || '-Q' || quarter(ts) AS quarterly, date FROM meta""",
)
def period_columns(spark: SparkSession, sf: str) -> DataFrame:
    return st.posts_meta(spark, sf).select(
        "id", "created_utc", *[time.period(g).alias(g) for g in ("daily", "monthly", "quarterly")],
        time.created_date().alias("date"),
    )


@query(
    "time_parts",
    """WITH {posts}
    SELECT id, created_utc, dayofweek(ts) + 1 AS day_of_week, hour(ts) AS hour_of_day,
           CAST(dayofweek(ts) IN (0, 6) AS BIGINT) AS is_weekend, length(body) AS body_length,
           ['Sun', 'Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat'][dayofweek(ts) + 1] AS day_name
    FROM posts WHERE data_type = 'comment'""",
)
def time_parts(spark: SparkSession, sf: str) -> DataFrame:
    dow = time.day_of_week()
    return st.comments(spark, sf).select(
        "id", "created_utc", dow.alias("day_of_week"), time.hour_of_day().alias("hour_of_day"),
        time.is_weekend().alias("is_weekend"), F.length("body").alias("body_length"),
        time.day_name(dow).alias("day_name"),
    )


def _sql_in(column: str, mapping, default: str | None) -> str:
    whens = " ".join(f"WHEN {column} IN ({_names(v)}) THEN '{k}'" for k, v in mapping.items())
    return f"CASE {whens}" + (f" ELSE '{default}'" if default else "") + " END"


def _sql_contains(column: str, mapping, default: str) -> str:
    whens = " ".join(
        "WHEN " + " OR ".join(f"contains({column}, '{p}')" for p in parts) + f" THEN '{k}'"
        for k, parts in mapping.items()
    )
    return f"CASE {whens} ELSE '{default}' END"


SIX_SQL = _sql_in("subreddit", vocab.SIX_WAY_CATEGORY, None)
FOUR_SQL = _sql_in("lower(trim(subreddit))", vocab.FOUR_WAY_CATEGORY, "Other")
FIVE_SQL = _sql_contains("lower(subreddit)", vocab.FIVE_WAY_SUBSTRINGS, "Other")
COARSE_SQL = _sql_contains("lower(subreddit)", vocab.COARSE_SUBSTRINGS, "Other")
TOOL_SQL = "CASE upper(trim(subreddit)) " + " ".join(f"WHEN '{t.upper()}' THEN '{t}'" for t in vocab.AI_TOOLS) + " END"


@query(
    "category_six",
    f"WITH {{meta}} SELECT {SIX_SQL} AS category, subreddit, count(*) AS n FROM meta GROUP BY ALL",
)
def category_six(spark: SparkSession, sf: str) -> DataFrame:
    df = engagement.with_category(st.posts_meta(spark, sf))
    return df.groupBy("category", "subreddit").agg(F.count(F.lit(1)).alias("n"))


@query(
    "category_four",
    f"WITH {{meta}} SELECT {FOUR_SQL} AS ai_category, subreddit, count(*) AS n FROM meta GROUP BY ALL",
)
def category_four(spark: SparkSession, sf: str) -> DataFrame:
    df = st.posts_meta(spark, sf)
    return df.groupBy(categories.by_folded_name().alias("ai_category"), "subreddit").agg(F.count(F.lit(1)).alias("n"))


POST_TEXT_SQL = "CASE WHEN data_type = 'submission' THEN coalesce(title, '') || ' ' || coalesce(selftext, '') ELSE body END"
MENTION_SQL = rf"regexp_matches(lower({POST_TEXT_SQL}), '{categories.mentions_pattern()}')"


@query(
    "category_five_baseline",
    f"""WITH {{posts}}
    SELECT id, subreddit, {COARSE_SQL} AS coarse,
      CASE WHEN {FIVE_SQL} = 'Baseline (AskReddit)' AND coalesce({MENTION_SQL}, FALSE)
           THEN '{vocab.BASELINE_MENTION_LABEL}' ELSE {FIVE_SQL} END AS ai_category
    FROM posts""",
)
def category_five_baseline(spark: SparkSession, sf: str) -> DataFrame:
    category = categories.with_baseline_mentions(categories.by_substring(), text.post_text())
    return st.posts(spark, sf).select(
        "id", "subreddit", categories.by_substring("subreddit", vocab.COARSE_SUBSTRINGS).alias("coarse"),
        category.alias("ai_category"),
    )


@query("tool_name", f"WITH {{meta}} SELECT {TOOL_SQL} AS tool, subreddit, count(*) AS n FROM meta GROUP BY ALL")
def tool_name(spark: SparkSession, sf: str) -> DataFrame:
    df = st.posts_meta(spark, sf)
    return df.groupBy(categories.tool_name().alias("tool"), "subreddit").agg(F.count(F.lit(1)).alias("n"))


@query(
    "post_text",
    f"""WITH {{posts}}
    SELECT id, data_type, length(t) AS n_chars, md5(t) AS digest
    FROM (SELECT id, data_type, {POST_TEXT_SQL} AS t FROM posts) WHERE length(t) > 30""",
)
def post_text(spark: SparkSession, sf: str) -> DataFrame:
    from forumlens.operators.text import long_enough, with_text

    df = long_enough(with_text(st.posts(spark, sf)), "text", 30)
    return df.select("id", "data_type", F.length("text").alias("n_chars"), F.md5("text").alias("digest"))


TITLE_SQL = r"""length(title) AS title_length, len(string_split_regex(title, '\s+')) AS title_word_count,
      CAST(contains(title, '?') AS BIGINT) AS is_question, CAST(ends_with(title, '?') AS BIGINT) AS ends_with_question,
      """ + ", ".join(
    f"CAST(starts_with(lower(title), '{w} ') AS BIGINT) AS starts_with_{w}"
    for w in ("how", "what", "why", "when", "where", "who")
) + """,
      CAST(contains(title, '!') AS BIGINT) AS has_exclamation, CAST(title = upper(title) AS BIGINT) AS is_all_caps"""


@query("title_features", f"WITH {{posts}} SELECT id, title, {TITLE_SQL} FROM posts WHERE data_type = 'submission'")
def title_features(spark: SparkSession, sf: str) -> DataFrame:
    features = text.title_features()
    return st.submissions(spark, sf).select("id", "title", *[c.alias(n) for n, c in features.items()])


@query(
    "text_surface",
    r"""WITH {posts}
    SELECT id, CAST(contains(body, '?') AS DOUBLE) AS has_question,
           CAST(contains(body, 'http') OR contains(body, 'www') AS DOUBLE) AS has_url,
           CAST(length(body) - length(replace(body, '!', '')) AS DOUBLE) AS exclamation_count,
           round(CASE WHEN length(regexp_replace(body, '\P{L}', '', 'g')) = 0 THEN 0.0
             ELSE length(regexp_replace(body, '\P{Lu}', '', 'g')) / length(regexp_replace(body, '\P{L}', '', 'g')) END, 6) AS uppercase_ratio
    FROM posts WHERE data_type = 'comment'""",
)
def text_surface(spark: SparkSession, sf: str) -> DataFrame:
    features = text.surface_features(F.col("body"))
    return st.comments(spark, sf).select("id", *[c.alias(n) for n, c in features.items()])


BIN_SQL = """CASE WHEN title_length < 50 THEN 'Very Short (<50)' WHEN title_length < 100 THEN 'Short (50-100)'
      WHEN title_length < 150 THEN 'Medium (100-150)' WHEN title_length < 200 THEN 'Long (150-200)'
      ELSE 'Very Long (200+)' END"""


@query(
    "length_bins",
    f"""WITH {{posts}}
    SELECT {BIN_SQL} AS length_bin, count(*) AS n, min(title_length) AS shortest, max(title_length) AS longest
    FROM (SELECT length(title) AS title_length FROM posts WHERE data_type = 'submission') GROUP BY ALL""",
)
def length_bins(spark: SparkSession, sf: str) -> DataFrame:
    size = F.length("title")
    return (
        st.submissions(spark, sf)
        .groupBy(text.length_bin(size).alias("length_bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(size).alias("shortest"), F.max(size).alias("longest"))
    )


@query(
    "score_transform",
    """WITH {meta}
    SELECT id, score, c AS score_clipped, round(ln(1 + c + 20), 6) AS score_log, round(exp(ln(1 + c + 20)) - 1 - 20, 6) AS score_back
    FROM (SELECT id, score, least(greatest(score, -20), 200) AS c FROM meta)""",
)
def score_transform(spark: SparkSession, sf: str) -> DataFrame:
    score = F.col("score")
    return st.posts_meta(spark, sf).select(
        "id", "score", scores.clipped(score).alias("score_clipped"), scores.log_score(score).alias("score_log"),
        scores.unlog_score(scores.log_score(score)).alias("score_back"),
    )


@query(
    "engagement_label",
    """WITH {meta}
    SELECT threshold, label_binary, count(*) AS n FROM (
      SELECT 8 AS threshold, CAST(score >= 8 AS DOUBLE) AS label_binary FROM meta
      UNION ALL SELECT 9, CAST(score >= 9 AS DOUBLE) FROM meta) GROUP BY ALL""",
)
def engagement_label(spark: SparkSession, sf: str) -> DataFrame:
    both = F.explode(
        F.array(*[F.struct(F.lit(k).alias("threshold"), scores.engaged(F.col("score"), k).alias("label")) for k in (8, 9)])
    )
    return (
        st.posts_meta(spark, sf)
        .select(both.alias("l"))
        .groupBy(F.col("l.threshold"), F.col("l.label").alias("label_binary"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "classifier_features",
    rf"""WITH {{posts}}
    SELECT id, ai_category, length(t) AS text_length, len(string_split_regex(t, '\s+')) AS word_count,
           hour(ts) AS hour_of_day, CAST(url IS NOT NULL AS BIGINT) AS has_url, coalesce(score, 0) AS score,
           coalesce(num_comments, 0) AS num_comments
    FROM (SELECT *, {FOUR_SQL} AS ai_category,
            regexp_replace(coalesce(title, '') || ' ' || coalesce(selftext, ''), 'http\S+|www\S+|\[.*?\]', '', 'g') AS t
          FROM posts WHERE data_type = 'submission')""",
)
def classifier_features(spark: SparkSession, sf: str) -> DataFrame:
    from forumlens.ml.features import submission_features

    return submission_features(st.submissions(spark, sf)).select(
        "id", "ai_category", "text_length", "word_count", "hour_of_day", "has_url", "score", "num_comments"
    )


TOKENS_SQL = r"list_filter(string_split_regex(lower({0}), '\W+'), lambda x: x <> '')"


@query(
    "benefit_flags",
    "WITH {posts} SELECT id, "
    + ", ".join(
        f"list_has_any(tokens, [{_names(words)}]) AS {lexicon.benefit_slug(name)}"
        for name, words in vocab.BENEFIT_KEYWORDS.items()
    )
    + f" FROM (SELECT id, {TOKENS_SQL.format(POST_TEXT_SQL)} AS tokens FROM posts)",
)
def benefit_flags(spark: SparkSession, sf: str) -> DataFrame:
    from forumlens.operators.lexicon import with_benefit_flags

    df = st.posts(spark, sf).select("id", text.tokens_regex(text.post_text()).alias("tokens"))
    return with_benefit_flags(df).drop("tokens")


@query(
    "breadth_class",
    """WITH {meta}
    SELECT author, n AS num_subreddits,
           CASE WHEN n = 1 THEN 'specialist' WHEN n <= 3 THEN 'broad' ELSE 'generalist' END AS author_category
    FROM (SELECT author, count(DISTINCT subreddit) AS n FROM meta GROUP BY author)""",
)
def breadth_class(spark: SparkSession, sf: str) -> DataFrame:
    stats = authors.author_stats(st.posts_meta(spark, sf))
    return stats.select(
        "author", "num_subreddits", categories.breadth_class(F.col("num_subreddits")).alias("author_category")
    )


# --- quality ---------------------------------------------------------------------------------


@query(
    "dataset_summary",
    """WITH {meta}
    SELECT data_type, min(created_utc) AS date_range_start, max(created_utc) AS date_range_end, count(*) AS total_rows
    FROM meta GROUP BY ALL""",
)
def dataset_summary(spark: SparkSession, sf: str) -> DataFrame:
    return quality.dataset_summary(st.posts_meta(spark, sf))


MISSING = [
    "id", "subreddit", "author", "body", "score", "created_utc", "parent_id", "link_id", "controversiality",
    "gilded", "date", "data_type", "title", "selftext", "num_comments", "url", "over_18",
]


@query(
    "missingness",
    "WITH {posts} SELECT subreddit, "
    + ", ".join(f"CAST(sum(CAST({c} IS NULL AS BIGINT)) AS BIGINT) AS {c}_nulls" for c in MISSING)
    + ", count(*) AS total_rows, "
    + ", ".join(f"round(sum(CAST({c} IS NULL AS BIGINT)) / count(*) * 100, 6) AS {c}_null_pct" for c in MISSING)
    + " FROM posts GROUP BY subreddit",
)
def missingness(spark: SparkSession, sf: str) -> DataFrame:
    return quality.missingness_pct(quality.missingness(st.posts(spark, sf), MISSING))


@query(
    "sentinel_rates",
    """WITH {posts}
    SELECT subreddit,
      round(sum(CASE WHEN author = '[deleted]' THEN 1 ELSE 0 END) / count(*) * 100, 6) AS pct_author_deleted,
      round(sum(CASE WHEN body = '[removed]' THEN 1 ELSE 0 END) / count(*) * 100, 6) AS pct_body_removed,
      round(sum(CASE WHEN selftext = '[removed]' THEN 1 ELSE 0 END) / count(*) * 100, 6) AS pct_selftext_removed,
      round(avg(controversiality), 6) AS avg_controversiality,
      round(sum(CASE WHEN controversiality > 0 THEN 1 ELSE 0 END) / count(*) * 100, 6) AS pct_controversial,
      round(avg(score), 6) AS avg_score,
      round(sum(CASE WHEN (body = '[removed]' OR selftext = '[removed]') AND controversiality > 0 THEN 1 ELSE 0 END) / count(*) * 100, 6) AS pct_removed_controversial
    FROM posts GROUP BY subreddit""",
)
def sentinel_rates(spark: SparkSession, sf: str) -> DataFrame:
    return quality.sentinel_rates(st.posts(spark, sf))


@query(
    "duplicate_ids",
    """WITH {meta}
    SELECT subreddit, count(*) AS num_duplicate_ids, CAST(sum(n) AS BIGINT) AS total_duplicate_rows
    FROM (SELECT subreddit, id, count(*) AS n FROM meta GROUP BY ALL HAVING count(*) > 1) GROUP BY subreddit""",
)
def duplicate_ids(spark: SparkSession, sf: str) -> DataFrame:
    # ids clash between neighbouring events, which the adapter puts in different communities
    return quality.duplicate_ids(st.posts_meta(spark, sf))


@query(
    "duplicate_ids_overall",
    """WITH {meta}
    SELECT data_type, count(*) AS num_duplicate_ids, CAST(sum(n) AS BIGINT) AS total_duplicate_rows
    FROM (SELECT data_type, id, count(*) AS n FROM meta GROUP BY ALL HAVING count(*) > 1) GROUP BY data_type""",
)
def duplicate_ids_overall(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_ids(st.posts_meta(spark, sf), by="data_type")


@query(
    "duplicate_authors",
    """WITH {meta}
    SELECT subreddit, count(*) FILTER (n > 1) AS num_duplicate_authors, count(*) AS total_authors,
           round(count(*) FILTER (n > 1) / count(*) * 100, 6) AS duplicate_author_pct
    FROM (SELECT subreddit, author, count(*) AS n FROM meta GROUP BY ALL) GROUP BY subreddit""",
)
def duplicate_authors(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_authors(st.posts_meta(spark, sf))


@query(
    "time_range",
    "WITH {meta} SELECT min(created_utc) AS min_timestamp, max(created_utc) AS max_timestamp FROM meta",
)
def time_range(spark: SparkSession, sf: str) -> DataFrame:
    return quality.time_range(st.posts_meta(spark, sf))


SCORE_SQL = """s AS (SELECT subreddit, min(score) AS min_score, quantile_disc(score, 0.25) AS q1,
      quantile_disc(score, 0.5) AS median, quantile_disc(score, 0.75) AS q3, max(score) AS max_score,
      round(avg(score), 6) AS avg_score FROM meta GROUP BY subreddit)"""


@query("score_summary", f"WITH {{meta}}, {SCORE_SQL} SELECT * FROM s")
def score_summary(spark: SparkSession, sf: str) -> DataFrame:
    return quality.score_summary(st.posts_meta(spark, sf))


@query(
    "score_summary_long",
    f"""WITH {{meta}}, {SCORE_SQL}
    SELECT subreddit, stat, score FROM (SELECT * EXCLUDE (avg_score) FROM s)
    UNPIVOT (score FOR stat IN (min_score, q1, median, q3, max_score))""",
)
def score_summary_long(spark: SparkSession, sf: str) -> DataFrame:
    return quality.score_summary_long(quality.score_summary(st.posts_meta(spark, sf)))


@query(
    "text_quality",
    "WITH {posts} SELECT subreddit, "
    + ", ".join(
        f"round(avg(length({c})), 6) AS avg_{c}_len, "
        f"round(sum(CASE WHEN length({c}) < 3 THEN 1 ELSE 0 END) / count(*) * 100, 6) AS pct_short_{c}, "
        f"round(sum(CASE WHEN length({c}) > 5000 THEN 1 ELSE 0 END) / count(*) * 100, 6) AS pct_long_{c}"
        for c in ("body", "title", "selftext")
    )
    + " FROM posts GROUP BY subreddit",
)
def text_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.text_quality(st.posts(spark, sf))


@query(
    "body_length_histogram",
    """WITH {posts}, v AS (SELECT avg(length(body)) AS v FROM posts GROUP BY subreddit),
    l AS (SELECT v, min(v) OVER () AS lo, max(v) OVER () AS hi FROM v)
    SELECT bin, round(lo + (hi - lo) / 30 * bin, 6) AS bin_start, round(lo + (hi - lo) / 30 * (bin + 1), 6) AS bin_end, count(*) AS n
    FROM (SELECT CAST(least(floor((v - lo) * 30 / (hi - lo)), 29) AS BIGINT) AS bin, lo, hi FROM l) GROUP BY ALL""",
)
def body_length_histogram(spark: SparkSession, sf: str) -> DataFrame:
    from forumlens.operators.histogram import histogram

    lengths = quality.text_quality(st.posts(spark, sf), columns=("body",))
    return histogram(lengths, F.col("avg_body_len"), 30)


# --- trips -----------------------------------------------------------------------------------


@query(
    "trip_daily",
    """SELECT year(l_shipdate) AS dt_year, month(l_shipdate) AS dt_month, day(l_shipdate) AS dt_day,
      count(*) AS num_trips, round(avg(l_quantity), 6) AS mean_trip_distance, round(max(l_tax), 6) AS max_mta_tax,
      round(quantile_disc(l_extendedprice, 0.95), 6) AS q95_fare_amount, round(min(l_discount), 6) AS min_tip_amount,
      CAST(ceil(avg(l_linenumber)) AS BIGINT) AS mean_passenger_count
    FROM lineitem WHERE year(l_shipdate) = 1998 GROUP BY ALL""",
)
def trip_daily(spark: SparkSession, sf: str) -> DataFrame:
    return trips.daily_trips(st.trips(spark, sf), 1998)

"""Queries over text cleaning, tokens and lexicon scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens import vocab
from forumlens.functions import categories, lexicon, text
from forumlens.ml import bayes
from forumlens.operators import lexicon as lx
from forumlens.operators import text as tx
from forumlens.plans.registry import query
from forumlens.plans.tables import COARSE_SQL, FIVE_SQL, POST_TEXT_SQL, TOOL_SQL, _names
from forumlens.session import stage
from forumlens.sources import sample_tables as st

# Word lists are arguments; these cover the words the derived posts hold.
POSITIVE = ["better", "excited", "faster", "good", "happy", "in", "the"]
NEGATIVE = ["and", "angry", "bad", "hate", "of", "sad", "scared", "terrible", "wrong"]
PROFANE = ["angry", "bad", "hate", "rant", "risk", "terrible", "the", "wrong"]
STOP = [*vocab.MODEL_STOP_WORDS, "the", "of", "and", "is", "on", "der", "die", "le", "la", "el"]
LEMMAS = {"compared": "compare", "docs": "doc", "excited": "excite", "faster": "fast", "better": "good", "was": "be"}
TOPIC_STOP = tx.default_stop_words(vocab.TOPIC_STOP_WORDS)
SURVEY = [
    ("Less time spent searching for information", 40.0),
    ("Faster coding and development", 55.0),
    ("Faster completion of repetitive tasks", 36.0),
    ("Increased productivity", 31.0),
    ("Faster learning of new technologies, frameworks, languages, etc.", 27.0),
    ("Less mental effort required for coding and development", 23.0),
    ("Better coding and development experience", 18.0),
    ("Other", 2.0),
]

TEXT_SQL = f"{{posts}}, t AS (SELECT *, {POST_TEXT_SQL} AS text FROM posts)"


def _replace(value: str, pattern: str, new: str) -> str:
    return f"regexp_replace({value}, '{pattern}', '{new}', 'g')"


def _clean_full(value: str, original_order: bool = False) -> str:
    if original_order:
        for pattern, new in (
            (text.URLS, ""), (text.SENTINELS, ""), (text.MARKDOWN_LINK, r"\1"), (text.USER_MENTION, ""),
            (text.COMMUNITY_MENTION, ""), (text.SPACES, " "),
        ):
            value = _replace(value, pattern, new)
        return f"trim({value})"
    value = _replace(value, text.MARKDOWN_LINK, r"\1")
    value = _replace(value, f"{text.URLS}|{text.SENTINELS}", "")
    value = _replace(value, rf"(^|[^a-zA-Z0-9_])(?:{text.USER_MENTION}|{text.COMMUNITY_MENTION})", r"\1")
    return f"trim({_replace(value, text.SPACES, ' ')})"


def _clean_light(value: str) -> str:
    value = _replace(f"coalesce({value}, '')", text.MARKDOWN_LINK, r"\1")
    return _replace(_replace(value, f"{text.SHORT_URLS}|{text.SENTINELS}", ""), text.SPACES, " ")


def _clean_letters(value: str) -> str:
    dropped = _replace(value, f"{text.SHORT_URLS}|{text.BRACKETED}|{text.NOT_LETTERS}", "")
    return _replace(f"lower({dropped})", text.SPACES, " ")


def _split(value: str, pattern: str) -> str:
    return f"list_filter(string_split_regex(lower({value}), '{pattern}'), lambda x: x <> '')"


def _digest(df: DataFrame, column: str) -> DataFrame:
    return df.select(
        "id", "data_type", F.length(column).alias("n_chars"), F.md5(column).alias("digest")
    )


def _digest_sql(expression: str, more_than: int | None = None) -> str:
    limit = "" if more_than is None else f" WHERE length(c) > {more_than}"
    return f"""WITH {TEXT_SQL} SELECT id, data_type, length(c) AS n_chars, md5(c) AS digest
    FROM (SELECT id, data_type, {expression} AS c FROM t){limit}"""


def _posts(spark: SparkSession, sf: str) -> DataFrame:
    return tx.with_text(st.posts(spark, sf))


def _light(spark: SparkSession, sf: str) -> DataFrame:
    clean = text.clean_light(F.col("text"))
    return tx.with_kept(_posts(spark, sf), "processed_text", clean, lambda c: F.length(c) > 0)


def _letters(spark: SparkSession, sf: str) -> DataFrame:
    clean = text.clean_letters(F.col("text"))
    return tx.with_kept(_posts(spark, sf), "processed_text", clean, lambda c: F.length(c) > 3)


# --- cleaning --------------------------------------------------------------------------------


@query("clean_full", _digest_sql(_clean_full("text"), 10))
def clean_full(spark: SparkSession, sf: str) -> DataFrame:
    return _digest(tx.cleaned(_posts(spark, sf)), "cleaned")


@query("clean_full_original_order", _digest_sql(_clean_full("text", True), 10))
def clean_full_original_order(spark: SparkSession, sf: str) -> DataFrame:
    return _digest(tx.cleaned(_posts(spark, sf), original_order=True), "cleaned")


@query("clean_light", _digest_sql(_clean_light("text"), 0))
def clean_light(spark: SparkSession, sf: str) -> DataFrame:
    return _digest(_light(spark, sf), "processed_text")


@query("clean_letters", _digest_sql(_clean_letters("text"), 3))
def clean_letters(spark: SparkSession, sf: str) -> DataFrame:
    return _digest(_letters(spark, sf), "processed_text")


@query("clean_brackets", _digest_sql(_replace("text", f"{text.SHORT_URLS}|{text.BRACKETED}", "")))
def clean_brackets(spark: SparkSession, sf: str) -> DataFrame:
    return _digest(_posts(spark, sf).withColumn("c", text.clean_brackets(F.col("text"))), "c")


# --- tokens ----------------------------------------------------------------------------------


def _tokens(df: DataFrame, tokens) -> DataFrame:
    return df.select("id", tokens.alias("tokens")).select(
        "id", F.size("tokens").alias("n_tokens"), F.md5(F.array_join("tokens", " ")).alias("digest")
    )


def _tokens_sql(expression: str, where: str = "") -> str:
    return f"""WITH {TEXT_SQL} SELECT id, len(k) AS n_tokens, md5(array_to_string(k, ' ')) AS digest
    FROM (SELECT id, {expression} AS k FROM t){where}"""


REGEX_SQL = _split("text", r"\W+")
STOPPED_SQL = f"list_filter({REGEX_SQL}, lambda x: x NOT IN ({_names(sorted(set(STOP)))}))"
TOPIC_SQL = (
    f"list_filter({REGEX_SQL}, lambda x: regexp_full_match(x, '[a-z]{{3,}}') AND NOT starts_with(x, 'http') "
    f"AND NOT starts_with(x, 'www') AND x NOT IN ({_names(TOPIC_STOP)}))"
)


@query("tokens_regex", _tokens_sql(REGEX_SQL))
def tokens_regex(spark: SparkSession, sf: str) -> DataFrame:
    return _tokens(_posts(spark, sf), text.tokens_regex(F.col("text")))


@query("tokens_space", _tokens_sql(_split("text", r"\s+")))
def tokens_space(spark: SparkSession, sf: str) -> DataFrame:
    return _tokens(_posts(spark, sf), text.tokens_space(F.col("text")))


NORMAL_SQL = r"list_filter(list_transform(string_split_regex({0}, '\s+'), lambda x: lower(regexp_replace(x, '[^A-Za-z]', '', 'g'))), lambda x: x <> '')"


@query("tokens_normalised", _tokens_sql(NORMAL_SQL.format("text")))
def tokens_normalised(spark: SparkSession, sf: str) -> DataFrame:
    return _tokens(_posts(spark, sf), text.tokens_normalised(F.col("text")))


@query("tokens_no_stop", _tokens_sql(STOPPED_SQL))
def tokens_no_stop(spark: SparkSession, sf: str) -> DataFrame:
    return _tokens(_posts(spark, sf), text.without_stop_words(text.tokens_regex(F.col("text")), STOP))


@query("tokens_filtered", _tokens_sql(TOPIC_SQL, " WHERE len(k) > 0"))
def tokens_filtered(spark: SparkSession, sf: str) -> DataFrame:
    df = tx.topic_documents(_posts(spark, sf), TOPIC_STOP, "text", 0)
    return _tokens(df, F.col("tokens_final"))


LEMMA_SQL = "CASE x " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in LEMMAS.items()) + " ELSE x END"


@query("tokens_lemma", _tokens_sql(f"list_transform({REGEX_SQL}, lambda x: {LEMMA_SQL})"))
def tokens_lemma(spark: SparkSession, sf: str) -> DataFrame:
    df = _posts(spark, sf).withColumn("tokens", text.tokens_regex(F.col("text")))
    return _tokens(tx.lemmatise(df, LEMMAS), F.col("tokens"))


@query("tokens_lemma_joined", _tokens_sql(f"list_transform({REGEX_SQL}, lambda x: {LEMMA_SQL})"))
def tokens_lemma_joined(spark: SparkSession, sf: str) -> DataFrame:
    df = _posts(spark, sf).withColumn("tokens", text.tokens_regex(F.col("text")))
    table = spark.createDataFrame(list(LEMMAS.items()), "form string, lemma string")
    return _tokens(tx.lemmatise_by_join(df, table), F.col("tokens"))


PREPARED_SQL = f"""{TEXT_SQL}, c AS (SELECT *, {_clean_full("text")} AS cleaned FROM t),
    k AS (SELECT *, {NORMAL_SQL.format("cleaned")} AS tokens FROM c WHERE length(cleaned) > 10)"""


def _prepared(spark: SparkSession, sf: str) -> DataFrame:
    return tx.with_tokens(tx.cleaned(_posts(spark, sf)))


@query(
    "token_profile",
    f"""WITH {PREPARED_SQL}
    SELECT count(subreddit) AS total_records, round(avg(len(tokens)), 6) AS avg_tokens, min(len(tokens)) AS min_tokens,
           max(len(tokens)) AS max_tokens FROM k""",
)
def token_profile(spark: SparkSession, sf: str) -> DataFrame:
    return tx.token_profile(_prepared(spark, sf))


@query(
    "prepare_comments",
    f"""WITH {PREPARED_SQL}
    SELECT id, subreddit, len(tokens) AS token_count, md5(array_to_string(tokens, ' ')) AS digest, score, controversiality
    FROM k WHERE data_type = 'comment'""",
)
def prepare_comments(spark: SparkSession, sf: str) -> DataFrame:
    return tx.prepare(st.comments(spark, sf), "comments").select(
        "id", "subreddit", "token_count", F.md5("processed_text").alias("digest"), "score", "controversiality"
    )


@query(
    "prepare_submissions",
    f"""WITH {PREPARED_SQL}
    SELECT id, subreddit, len(tokens) AS token_count, md5(array_to_string(tokens, ' ')) AS digest, score, num_comments
    FROM k WHERE data_type = 'submission'""",
)
def prepare_submissions(spark: SparkSession, sf: str) -> DataFrame:
    return tx.prepare(st.submissions(spark, sf), "submissions").select(
        "id", "subreddit", "token_count", F.md5("processed_text").alias("digest"), "score", "num_comments"
    )


@query(
    "term_statistics",
    f"""WITH {TEXT_SQL}, w AS (SELECT event_id, unnest({STOPPED_SQL}) AS term FROM t WHERE data_type = 'comment'),
    p AS (SELECT event_id, term, count(*) AS n FROM w GROUP BY ALL)
    SELECT term, CAST(sum(n) AS BIGINT) AS total_count, count(*) AS doc_count,
      round(ln(((SELECT count(*) FROM t WHERE data_type = 'comment') + 1) / (count(*) + 1)), 6) AS idf
    FROM p GROUP BY term""",
)
def term_statistics(spark: SparkSession, sf: str) -> DataFrame:
    df = _posts(spark, sf).where("data_type = 'comment'")
    return tx.term_statistics(
        df.withColumn("tokens", text.without_stop_words(text.tokens_regex(F.col("text")), STOP))
    )


# --- sentiment -------------------------------------------------------------------------------


def _hits(tokens: str, words) -> str:
    return f"len(list_filter({tokens}, lambda x: x IN ({_names(sorted(set(words)))})))"


def _balance(p: str, n: str) -> str:
    return f"CASE WHEN {p} + {n} = 0 THEN 0.0 ELSE CAST({p} - {n} AS DOUBLE) / ({p} + {n}) END"


DISTINCT_SQL = f"""{TEXT_SQL}, c AS (SELECT *, {_clean_letters("text")} AS processed FROM t),
    w AS (SELECT *, list_distinct({_split("processed", r"\s+")}) AS words FROM c WHERE length(processed) > 3),
    h AS (SELECT *, {_hits("words", POSITIVE)} AS p, {_hits("words", NEGATIVE)} AS n FROM w),
    s AS (SELECT *, {_balance("p", "n")} AS sentiment FROM h)"""
WEIGHTED_SQL = f"""{TEXT_SQL}, c AS (SELECT *, {_clean_light("text")} AS processed FROM t),
    w AS (SELECT *, {_split("processed", r"\s+")} AS words FROM c WHERE length(processed) > 0),
    h AS (SELECT *, {_hits("words", POSITIVE)} AS p, {_hits("words", NEGATIVE)} AS n FROM w),
    s AS (SELECT *, greatest(-1.0, least(1.0, 1.2 * ({_balance("p", "n")}))) AS sentiment FROM h)"""


def _distinct_scored(spark: SparkSession, sf: str) -> DataFrame:
    return lx.with_sentiment_distinct(_letters(spark, sf), POSITIVE, NEGATIVE)


def _weighted_scored(spark: SparkSession, sf: str) -> DataFrame:
    return lx.with_sentiment_weighted(_light(spark, sf), POSITIVE, NEGATIVE)


@query("sentiment_distinct", f"WITH {DISTINCT_SQL} SELECT id, round(sentiment, 6) AS sentiment FROM s")
def sentiment_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return _distinct_scored(spark, sf).select("id", "sentiment")


@query("sentiment_weighted", f"WITH {WEIGHTED_SQL} SELECT id, round(sentiment, 6) AS sentiment FROM s")
def sentiment_weighted(spark: SparkSession, sf: str) -> DataFrame:
    return _weighted_scored(spark, sf).select("id", "sentiment")


@query(
    "sentiment_label",
    f"""WITH {DISTINCT_SQL} SELECT CASE WHEN sentiment > 0 THEN 'positive' WHEN sentiment < 0 THEN 'negative' ELSE 'neutral' END
      AS sentiment_label, count(*) AS n FROM s GROUP BY ALL""",
)
def sentiment_label(spark: SparkSession, sf: str) -> DataFrame:
    df = lx.with_sentiment_label(_distinct_scored(spark, sf))
    return df.groupBy("sentiment_label").agg(F.count(F.lit(1)).alias("n"))


MENTION = f"regexp_matches(lower(processed), '{categories.mentions_pattern()}')"
PERIOD_SQL = f"""{WEIGHTED_SQL}, p AS (SELECT subreddit, strftime(ts, '%Y-%m') AS time_period,
      CASE WHEN {FIVE_SQL} = 'Baseline (AskReddit)' AND {MENTION} THEN '{vocab.BASELINE_MENTION_LABEL}' ELSE {FIVE_SQL} END AS ai_category,
      sentiment, score, id FROM s),
    g AS (SELECT subreddit, ai_category, time_period, avg(sentiment) AS avg_sentiment, stddev(sentiment) AS sentiment_std,
      count(sentiment) AS sentiment_count, avg(score) AS avg_score, count(id) AS post_count FROM p GROUP BY ALL)"""


@query(
    "sentiment_by_period",
    f"""WITH {PERIOD_SQL} SELECT subreddit, ai_category, time_period, round(avg_sentiment, 6) AS avg_sentiment,
      round(sentiment_std, 6) AS sentiment_std, sentiment_count, round(avg_score, 6) AS avg_score, post_count FROM g""",
)
def sentiment_by_period(spark: SparkSession, sf: str) -> DataFrame:
    return lx.sentiment_by_period(lx.with_ai_category(_weighted_scored(spark, sf)))


@query(
    "sentiment_category_periods",
    f"""WITH {PERIOD_SQL} SELECT ai_category, time_period, round(avg(avg_sentiment), 6) AS avg_sentiment,
      round(sum(avg_sentiment * sentiment_count) / sum(sentiment_count), 6) AS weighted_sentiment,
      CAST(sum(post_count) AS BIGINT) AS post_count, round(avg(avg_score), 6) AS avg_score FROM g GROUP BY ALL""",
)
def sentiment_category_periods(spark: SparkSession, sf: str) -> DataFrame:
    return lx.category_periods(lx.sentiment_by_period(lx.with_ai_category(_weighted_scored(spark, sf))))


@query(
    "sentiment_overview",
    f"""WITH {PERIOD_SQL} SELECT ai_category, grouping(ai_category) AS is_overall, round(avg(avg_sentiment), 6) AS mean_sentiment,
      round(stddev(avg_sentiment), 6) AS std_sentiment, count(*) AS records, count(DISTINCT subreddit) AS communities,
      count(DISTINCT time_period) AS periods, CAST(sum(post_count) AS BIGINT) AS total_posts
    FROM g GROUP BY GROUPING SETS ((), (ai_category))""",
)
def sentiment_overview(spark: SparkSession, sf: str) -> DataFrame:
    return lx.sentiment_overview(lx.sentiment_by_period(lx.with_ai_category(_weighted_scored(spark, sf))))


@query(
    "sentiment_by_category",
    f"""WITH {DISTINCT_SQL} SELECT {COARSE_SQL} AS ai_category, strftime(ts, '%Y-%m') AS period,
      round(avg(sentiment), 6) AS avg_sentiment, count(id) AS post_count FROM s GROUP BY ALL""",
)
def sentiment_by_category(spark: SparkSession, sf: str) -> DataFrame:
    category = categories.by_substring("subreddit", vocab.COARSE_SUBSTRINGS)
    return lx.sentiment_by_category(_distinct_scored(spark, sf).withColumn("ai_category", category))


# --- emotion ---------------------------------------------------------------------------------

_LABELS = "[" + _names(vocab.EMOTION_KEYWORDS) + "]"


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


EMOTION_SQL = f"""{PREPARED_SQL},
    f AS (SELECT *, list_filter(tokens, lambda x: x IN ({_quoted(lexicon.all_words(vocab.EMOTION_KEYWORDS))})) AS found FROM k),
    e AS (SELECT *, [{", ".join("len(list_filter(found, lambda x: x IN (" + _quoted(w) + ")))" for w in vocab.EMOTION_KEYWORDS.values())}] AS counts FROM f),
    emo AS (SELECT *, CASE WHEN len(found) = 0 THEN 'neutral' ELSE {_LABELS}[list_position(counts, list_max(counts))] END AS emotion_class FROM e)"""


def _emotions(spark: SparkSession, sf: str) -> DataFrame:
    return lx.with_emotion(_prepared(spark, sf))


@query("emotion_class", f"WITH {EMOTION_SQL} SELECT id, data_type, emotion_class FROM emo")
def emotion_class(spark: SparkSession, sf: str) -> DataFrame:
    return _emotions(spark, sf).select("id", "data_type", "emotion_class")


TOOL_EMOTION_SQL = f"""{EMOTION_SQL}, g AS (SELECT {TOOL_SQL} AS "Tool", emotion_class, count(*) AS "Activity", avg(score) AS avg_score,
      avg(len(tokens)) AS avg_tokens FROM emo WHERE {TOOL_SQL} IS NOT NULL GROUP BY ALL),
    v AS (SELECT *, CAST(sum("Activity") OVER (PARTITION BY "Tool") AS BIGINT) AS "Activity_total" FROM g)"""


@query(
    "emotion_by_tool",
    f"""WITH {TOOL_EMOTION_SQL} SELECT "Tool", emotion_class, "Activity", round(avg_score, 6) AS avg_score,
      round(avg_tokens, 6) AS avg_tokens, "Activity_total", round("Activity" / "Activity_total", 6) AS activity_percent FROM v""",
)
def emotion_by_tool(spark: SparkSession, sf: str) -> DataFrame:
    return lx.emotion_by_tool(_emotions(spark, sf).transform(lx.with_tool))


@query(
    "emotion_tool_matrix",
    f"""WITH {TOOL_EMOTION_SQL} SELECT "Tool", """
    + ", ".join(
        f"""round(coalesce(max("Activity" / "Activity_total") FILTER (emotion_class = '{e}'), 0), 6) AS {e}"""
        for e in vocab.EMOTION_LABELS
    )
    + ' FROM v GROUP BY "Tool"',
)
def emotion_tool_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return lx.emotion_matrix(lx.emotion_by_tool(_emotions(spark, sf).transform(lx.with_tool)))


def _vector_words(label: str) -> list[str]:
    return [w for w, tags in vocab.EMOTION_VECTOR_WORDS.items() if label in tags]


VECTOR_SQL = rf"""{TEXT_SQL}, f AS (SELECT *, list_filter(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}_]+'),
      lambda x: x IN ({_names(sorted(vocab.EMOTION_VECTOR_WORDS))})) AS found FROM t),
    n AS (SELECT *, {", ".join(f"{_hits('found', _vector_words(x))} AS n_{x}" for x in vocab.EMOTION_VECTOR_LABELS)} FROM f),
    q AS (SELECT *, {" + ".join(f"n_{x}" for x in vocab.EMOTION_VECTOR_LABELS)} AS total FROM n),
    v AS (SELECT id, subreddit, {", ".join(f"CASE WHEN total > 0 THEN n_{x} / total ELSE 0 END AS {x}" for x in vocab.EMOTION_VECTOR_LABELS)} FROM q)"""


@query(
    "emotion_vector",
    f"WITH {VECTOR_SQL} SELECT id, "
    + ", ".join(f"round({x}, 6) AS {x}" for x in vocab.EMOTION_VECTOR_LABELS)
    + " FROM v",
)
def emotion_vector(spark: SparkSession, sf: str) -> DataFrame:
    return lx.with_emotion_vector(_posts(spark, sf)).select("id", *vocab.EMOTION_VECTOR_LABELS)


@query(
    "emotion_profile",
    f"WITH {VECTOR_SQL} SELECT subreddit, "
    + ", ".join(f"round(avg({x}), 6) AS {x}" for x in vocab.EMOTION_VECTOR_LABELS)
    + " FROM v GROUP BY subreddit",
)
def emotion_profile(spark: SparkSession, sf: str) -> DataFrame:
    return lx.emotion_profile(lx.with_emotion_vector(_posts(spark, sf)))


# --- profanity and benefits ------------------------------------------------------------------

PROFANE_SQL = f"{PREPARED_SQL}, b AS (SELECT *, {_hits('tokens', PROFANE)} AS bad, len(tokens) AS n FROM k)"


@query(
    "profanity_rate",
    f"""WITH {PROFANE_SQL} SELECT subreddit, count(*) AS total_posts, CAST(sum(n) AS BIGINT) AS total_tokens,
      CAST(sum(bad) AS BIGINT) AS total_bad_words, round(avg(CASE WHEN n > 0 THEN bad / n * 100 ELSE 0 END), 6) AS avg_bad_word_pct,
      round(CASE WHEN sum(n) > 0 THEN sum(bad) / sum(n) * 100 END, 6) AS overall_bad_word_pct FROM b GROUP BY subreddit""",
)
def profanity_rate(spark: SparkSession, sf: str) -> DataFrame:
    return lx.profanity_rate(_prepared(spark, sf), PROFANE)


@query(
    "profanity_rate_joined",
    f"""WITH {PROFANE_SQL} SELECT subreddit, count(*) AS total_posts, CAST(sum(n) AS BIGINT) AS total_tokens,
      CAST(sum(bad) AS BIGINT) AS total_bad_words,
      round(CASE WHEN sum(n) > 0 THEN sum(bad) / sum(n) * 100 END, 6) AS overall_bad_word_pct FROM b GROUP BY subreddit""",
)
def profanity_rate_joined(spark: SparkSession, sf: str) -> DataFrame:
    words = spark.createDataFrame([(w,) for w in PROFANE], "word string")
    return lx.profanity_rate_by_join(_prepared(spark, sf), words)


@query(
    "profanity_top",
    f"""WITH {PREPARED_SQL}, w AS (SELECT subreddit, unnest(tokens) AS token FROM k),
    g AS (SELECT subreddit, token, count(*) AS count FROM w WHERE token IN ({_names(PROFANE)}) GROUP BY ALL)
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY count DESC, token) AS rank FROM g) WHERE rank <= 5""",
)
def profanity_top(spark: SparkSession, sf: str) -> DataFrame:
    return lx.profanity_top(_prepared(spark, sf), PROFANE, 5)


FLAGS_SQL = ", ".join(
    f"list_has_any(tokens, [{_names(words)}]) AS {lexicon.benefit_slug(name)}"
    for name, words in vocab.BENEFIT_KEYWORDS.items()
)
_SURVEY_SQL = {vocab.SURVEY_TO_BENEFIT.get(name): value for name, value in SURVEY}


@query(
    "benefit_vs_survey",
    f"WITH {PREPARED_SQL}, f AS (SELECT {FLAGS_SQL} FROM k), b AS (SELECT unnest(["
    + ", ".join(
        f"{{{{'benefit': '{name}', 'percentage': CAST({_SURVEY_SQL.get(name, 0.0)} AS DOUBLE), "
        f"'post_pct': round(sum(CAST({lexicon.benefit_slug(name)} AS BIGINT)) / count(*) * 100, 6)}}}}".replace("{{", "{").replace("}}", "}")
        for name in vocab.BENEFIT_KEYWORDS
    )
    + "]) AS s FROM f) SELECT s.benefit, s.percentage, s.post_pct FROM b",
)
def benefit_vs_survey(spark: SparkSession, sf: str) -> DataFrame:
    survey = spark.createDataFrame(SURVEY, "benefit string, percentage double")
    measured = lx.benefit_percentages(lx.with_benefit_flags(_prepared(spark, sf)))
    return lx.benefit_vs_survey(measured, survey)


@query(
    "monthly_tokens",
    f"""WITH {PREPARED_SQL} SELECT strftime(ts, '%Y-%m') AS year_month, count(*) AS comment_count,
      count(DISTINCT author) AS unique_authors, round(avg(len(tokens)), 6) AS avg_tokens_per_comment,
      round(avg(score), 6) AS avg_score FROM k GROUP BY ALL""",
)
def monthly_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return lx.monthly_tokens(_prepared(spark, sf))


# --- sentiment by counts -----------------------------------------------------------------------
# Trained on labelled documents: toxic ones are the negative class. Every fifth labelled document is held out.

_LABELLED = "SELECT doc_id, CAST(toxic = 0 AS INTEGER) AS label FROM labels"
_TOKENS = "regexp_extract_all(lower(text), '[a-z'']+|[.!?,;:]')"
_NEGATORS = "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in bayes.NEGATORS) + ")"
_MARKS = "(" + ", ".join(f"'{m}'" for m in bayes.MARKS) + ")"
BAYES_SQL = f"""tokens AS (SELECT doc_id, unnest(w) AS token, unnest(range(len(w))) AS pos FROM (SELECT doc_id, {_TOKENS} AS w FROM documents)),
    seen AS (SELECT doc_id, pos, token, lag(token, 1) OVER o AS t1, lag(token, 2) OVER o AS t2, lag(token, 3) OVER o AS t3
      FROM tokens WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
    marked AS (SELECT doc_id, pos, CASE WHEN token IN {_MARKS} THEN NULL WHEN t1 IN {_NEGATORS}
        OR (t2 IN {_NEGATORS} AND t1 NOT IN {_MARKS}) OR (t3 IN {_NEGATORS} AND t1 NOT IN {_MARKS} AND t2 NOT IN {_MARKS})
        THEN 'not_' || token ELSE token END AS word FROM seen),
    feats AS (SELECT doc_id, word AS feature FROM marked WHERE word IS NOT NULL
      UNION SELECT doc_id, word || ' ' || lead(word) OVER (PARTITION BY doc_id ORDER BY pos) FROM marked),
    known AS (SELECT * FROM ({_LABELLED}) WHERE doc_id % 5 <> 0 AND doc_id IN (SELECT doc_id FROM documents)),
    al AS (SELECT count(*) FILTER (label = 1) AS a1, count(*) FILTER (label = 0) AS a0 FROM known),
    n AS (SELECT feature, count(*) FILTER (label = 1) AS n1, count(*) FILTER (label = 0) AS n0 FROM feats JOIN known USING (doc_id)
      WHERE feature IS NOT NULL GROUP BY feature HAVING count(*) >= 3),
    cells AS (SELECT n.*, a1, a0, unnest([n1, n0, a1 - n1, a0 - n0]) AS c, unnest([n1 + n0, n1 + n0, a1 + a0 - n1 - n0, a1 + a0 - n1 - n0]) AS r,
      unnest([a1, a0, a1, a0]) AS k FROM n, al),
    rated AS (SELECT feature, n1, n0, a1, a0, sum(CASE WHEN c > 0 THEN c / (a1 + a0) * ln(c * (a1 + a0) / (r * k)) ELSE 0 END) AS mi
      FROM cells GROUP BY ALL),
    model AS (SELECT feature, n1, n0, mi, ln(((n1 + 1) / (a1 + 2)) / ((n0 + 1) / (a0 + 2))) AS weight,
        ln((1 - (n1 + 1) / (a1 + 2)) / (1 - (n0 + 1) / (a0 + 2))) AS without, ln((a1 + 1) / (a0 + 1)) AS prior
      FROM rated ORDER BY round(mi, 12) DESC, feature LIMIT {{limit}}),
    odds AS (SELECT d.doc_id, d.text, (SELECT max(prior) + sum(without) FROM model) + coalesce(g.gain, 0) AS log_odds FROM documents d LEFT JOIN (
      SELECT doc_id, sum(weight - without) AS gain FROM feats JOIN model USING (feature) GROUP BY doc_id) g USING (doc_id))"""
#: Features of the model: few, since few labels are given.
FEATURES = 40


def _bayes(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    docs = bayes.with_features(st.table(spark, sf, "documents").select("doc_id", "text"))
    labels = st.table(spark, sf, "labels").select("doc_id", (F.col("toxic") == 0).cast("int").alias("label"))
    train = stage(docs.join(labels.where("doc_id % 5 <> 0"), "doc_id").select("doc_id", "label", "features"))
    return docs, labels, stage(bayes.fit(train, max_features=FEATURES))


@query("sentiment_model", f"WITH {BAYES_SQL.format(limit=FEATURES)} SELECT feature, n1, n0, round(mi, 6) AS mi, round(weight, 6) AS weight, "
       "round(without, 6) AS without, round(prior, 6) AS prior FROM model")  # fmt: skip
def sentiment_model(spark: SparkSession, sf: str) -> DataFrame:
    return _bayes(spark, sf)[2]


@query("sentiment_model_scores", f"WITH {BAYES_SQL.format(limit=FEATURES)} SELECT doc_id, round(log_odds, 6) AS log_odds, "
       "CASE WHEN log_odds > 0 THEN 'positive' WHEN log_odds < 0 THEN 'negative' ELSE 'neutral' END AS sentiment_model FROM odds")  # fmt: skip
def sentiment_model_scores(spark: SparkSession, sf: str) -> DataFrame:
    docs, _, model = _bayes(spark, sf)
    return bayes.score(docs, model, "doc_id").select("doc_id", "log_odds", "sentiment_model")


# Held-out documents by class, and how many of them the model and the sign of the lexicon score get right.
@query(
    "sentiment_model_accuracy",
    f"""WITH {BAYES_SQL.format(limit=FEATURES)}, words AS (SELECT doc_id, log_odds, list_distinct(regexp_split_to_array(lower(text), '\\s+')) AS w FROM odds),
    h AS (SELECT doc_id, log_odds, {_hits("w", POSITIVE)} AS p, {_hits("w", NEGATIVE)} AS n FROM words)
    SELECT label, count(*) AS n_documents, count(*) FILTER (CAST(log_odds > 0 AS INTEGER) = label) AS model_right,
      count(*) FILTER (CAST(p > n AS INTEGER) = label) AS sign_right
    FROM h JOIN ({_LABELLED}) USING (doc_id) WHERE doc_id % 5 = 0 GROUP BY label""",
)
def sentiment_model_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels, model = _bayes(spark, sf)
    held = docs.join(labels.where("doc_id % 5 = 0"), "doc_id")
    both = lx.with_sentiment_distinct(bayes.score(held, model, "doc_id"), POSITIVE, NEGATIVE, "text")

    def right(value: str):
        return F.count_if((F.col(value) > 0).cast("int") == F.col("label"))

    return both.groupBy("label").agg(
        F.count(F.lit(1)).alias("n_documents"), right("log_odds").alias("model_right"), right("sentiment").alias("sign_right")
    )

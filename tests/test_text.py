"""Text cleaning, tokens and lexicon scores on hand-made rows."""

import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from forumlens import vocab
from forumlens.functions import lexicon, text
from forumlens.operators import lexicon as lx
from forumlens.operators import text as tx


def one(spark, expression, value, name="t"):
    df = spark.createDataFrame([(value,)], f"{name} string")
    return df.select(expression.alias("r")).first()["r"]


MESSY = "see [a](http://b) u/x r/y [deleted] menu/z"


def test_clean_full_orders(spark):
    assert one(spark, text.clean_full(F.col("t")), MESSY) == "see a menu/z"
    assert one(spark, text.clean_full(F.col("t"), original_order=True), MESSY) == "see [a]( men"


@pytest.mark.parametrize(
    "value, expected",
    [
        ("plain  text\n\there ", "plain text here"),
        ("www.x.org and bit.ly/abc and redd.it/q end", "and and end"),
        ("[removed]", ""),
        ("u/a,u/b r/c", ","),
        (None, None),
    ],
)
def test_clean_full_cases(spark, value, expected):
    assert one(spark, text.clean_full(F.col("t")), value) == expected


def test_clean_light_keeps_mentions(spark):
    assert one(spark, text.clean_light(F.col("t")), MESSY) == "see a u/x r/y menu/z"
    assert one(spark, text.clean_light(F.col("t")), None) == ""


def test_clean_letters_and_brackets(spark):
    value = "Hi! see http://a.b [x](y) 3 CATS\nok"
    assert one(spark, text.clean_letters(F.col("t")), value) == "hi see y cats ok"
    assert one(spark, text.clean_brackets(F.col("t")), value) == "Hi! see  (y) 3 CATS\nok"


def test_short_posts_are_dropped_and_text_is_cleaned_once(spark):
    df = spark.createDataFrame([("1", "short"), ("2", "long enough to stay here"), ("3", None)], "id string, text string")
    kept = tx.cleaned(df)
    assert [r["id"] for r in kept.collect()] == ["2"]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace(element_at(transform") == 1


def test_tokens(spark):
    assert one(spark, text.tokens_regex(F.col("t")), "It's 2 GPU-bound") == ["it", "s", "2", "gpu", "bound"]
    assert one(spark, text.tokens_space(F.col("t")), " A b\tC ") == ["a", "b", "c"]
    assert one(spark, text.tokens_normalised(F.col("t")), "It's 2 GPU-bound") == ["its", "gpubound"]


def test_topic_tokens(spark):
    stops = tx.default_stop_words(vocab.TOPIC_STOP_WORDS)
    got = one(spark, text.topic_tokens(F.col("t"), stops), "It's 2 GPU-bound doesn't httpx www2 abc1 a_b café models")
    assert got == ["gpu", "bound", "caf", "models"]


def test_stop_words_hold_split_contractions(spark):
    words = tx.default_stop_words()
    assert {"doesn", "t", "doesn't"} <= set(words)
    assert "doesn" not in tx.default_stop_words(split_stems=False)
    assert tx.default_stop_words(split_stems=False) == sorted(set(StopWordsRemover.loadDefaultStopWords("english")))


def test_lemmas_both_ways(spark):
    df = spark.createDataFrame([("1", ["docs", "are", "docs"]), ("2", ["x"])], "id string, tokens array<string>")
    expected = {"1": ["doc", "be", "doc"], "2": ["x"]}
    lemmas = {"docs": "doc", "are": "be"}
    assert {r["id"]: r["tokens"] for r in tx.lemmatise(df, lemmas).collect()} == expected
    table = spark.createDataFrame(list(lemmas.items()), "form string, lemma string")
    assert {r["id"]: r["tokens"] for r in tx.lemmatise_by_join(df, table).collect()} == expected
    rows = [("a", ["docs", "y"]), ("a", ["z"]), ("b", []), ("a", ["docs", "y"]), ("c", None), ("d", ["y", "docs", None, "docs"])]
    same = spark.createDataFrame(rows, "id string, tokens array<string>")
    twice = table.union(spark.createDataFrame([("docs", "zzz"), ("unused", "u")], table.schema))
    got = sorted((r["id"], str(r["tokens"])) for r in tx.lemmatise_by_join(same, twice).collect())
    new = [("a", ["doc", "y"]), ("a", ["z"]), ("b", []), ("a", ["doc", "y"]), ("c", None), ("d", ["y", "doc", None, "doc"])]
    assert got == sorted((i, str(t)) for i, t in new)


def test_whole_stop_list_and_expected_tokens(spark):
    words = set(vocab.TOPIC_STOP_WORDS)
    assert len(words) == 234 and {"them", "just", "isn't", "r", "noone", "literally", "it’s"} <= words
    stops = tx.default_stop_words(vocab.TOPIC_STOP_WORDS)
    sentence = "I think they should just run their own GPU model more, because it really helps everyone training locally"
    assert one(spark, text.topic_tokens(F.col("t"), stops), sentence) == ["run", "gpu", "model", "helps", "training", "locally"]


def test_title_features(spark):
    df = spark.createDataFrame([("WHY?",), ("how to x",), ("1234",), ("What now? yes",)], "title string")
    rows = [r.asDict() for r in df.select(*[c.alias(n) for n, c in text.title_features().items()]).collect()]
    why, how, digits, what = rows
    assert (why["is_question"], why["ends_with_question"], why["starts_with_why"], why["is_all_caps"]) == (1, 1, 0, 1)
    assert (how["starts_with_how"], how["title_word_count"], how["is_all_caps"]) == (1, 3, 0)
    assert digits["is_all_caps"] == 1
    assert (what["starts_with_what"], what["is_question"], what["ends_with_question"]) == (1, 1, 0)


def test_surface_features(spark):
    df = spark.createDataFrame([("AbÉ! http? !",), ("12",)], "t string")
    cols = [c.alias(n) for n, c in text.surface_features(F.col("t")).items()]
    first, second = df.select(*cols).collect()
    assert (first["has_question"], first["has_url"], first["exclamation_count"]) == (1.0, 1.0, 2.0)
    assert first["uppercase_ratio"] == pytest.approx(2 / 7)
    assert second["uppercase_ratio"] == 0.0


def scored(spark, value, scorer):
    df = spark.createDataFrame([(value,)], "processed_text string")
    return scorer(df, ["good", "so-so"], ["bad"]).first()["sentiment"]


def test_sentiment_variants(spark):
    assert scored(spark, "good good bad", lx.with_sentiment_distinct) == 0.0
    assert scored(spark, "good good bad", lx.with_sentiment_weighted) == pytest.approx(0.4)
    assert scored(spark, "good", lx.with_sentiment_weighted) == 1.0
    assert scored(spark, "so-so", lx.with_sentiment_weighted) == 0.0
    assert scored(spark, "nothing", lx.with_sentiment_distinct) == 0.0
    assert scored(spark, None, lx.with_sentiment_weighted) == 0.0


def test_sentiment_label(spark):
    df = spark.createDataFrame([(0.5,), (-0.1,), (0.0,), (None,)], "sentiment double")
    labels = [r["sentiment_label"] for r in lx.with_sentiment_label(df).collect()]
    assert labels == ["positive", "negative", "neutral", "neutral"]


def test_emotion_class_ties_and_empty(spark):
    df = spark.createDataFrame(
        [(["love", "angry"],), ([],), (["sad", "tears", "happy"],), (["x"],), (None,)], "tokens array<string>"
    )
    got = [r["emotion_class"] for r in lx.with_emotion(df).collect()]
    assert got == ["joy", "neutral", "sadness", "neutral", "neutral"]


def test_emotion_vector(spark):
    df = spark.createDataFrame([("Love the risk, HATE cafélove",), ("none",)], "text string")
    first, second = lx.with_emotion_vector(df).collect()
    assert first["joy"] == first["trust"] == first["fear"] == first["anger"] == first["negative"] == pytest.approx(0.2)
    assert all(second[e] == 0.0 for e in vocab.EMOTION_VECTOR_LABELS)


def test_profanity_rates_agree(spark):
    df = spark.createDataFrame(
        [("a", ["bad", "x", "bad"]), ("a", []), ("a", ["y"]), ("b", []), ("c", ["z", "bad"])],
        "subreddit string, tokens array<string>",
    )
    direct = {r["subreddit"]: r for r in lx.profanity_rate(df, ["bad"]).collect()}
    assert direct["a"]["overall_bad_word_pct"] == 50.0
    assert direct["a"]["avg_bad_word_pct"] == pytest.approx(200 / 9)
    assert direct["b"]["overall_bad_word_pct"] is None
    words = spark.createDataFrame([("bad",)], "word string")
    for r in lx.profanity_rate_by_join(df, words).collect():
        same = direct[r["subreddit"]]
        for column in ("total_posts", "total_tokens", "total_bad_words", "overall_bad_word_pct"):
            assert r[column] == same[column]


def test_benefits(spark):
    assert lexicon.benefit_slug("Less time searching") == "cat_less_time_searching"
    df = spark.createDataFrame([(["docs", "fast"],), (["x"],), (None,)], "tokens array<string>")
    rows = lx.benefit_percentages(lx.with_benefit_flags(df)).collect()
    values = {r["benefit"]: r["post_pct"] for r in rows}
    assert values["Less time searching"] == values["Faster coding"] == pytest.approx(100 / 3)
    survey = spark.createDataFrame([("Faster coding and development", 50.0), ("Other", 1.0)], "benefit string, percentage double")
    both = {r["benefit"]: r["percentage"] for r in lx.benefit_vs_survey(lx.benefit_percentages(lx.with_benefit_flags(df)), survey).collect()}
    assert len(both) == 8 and both["Faster coding"] == 50.0 and both["Repetitive tasks"] == 0.0
    empty = lx.benefit_percentages(lx.with_benefit_flags(df.limit(0))).collect()
    assert [r["post_pct"] for r in empty] == [0.0] * 8


def test_missing_text_columns_are_neutral(spark):
    df = spark.createDataFrame([("1",)], "id string")
    assert tx.with_text(df).first()["text"] == ""
    sub = spark.createDataFrame([("t", None)], "title string, selftext string")
    assert tx.with_text(sub).first()["text"] == "t "


def test_prepare_needs_its_columns(spark):
    with pytest.raises(ValueError, match="title"):
        tx.prepare(spark.createDataFrame([("1",)], "id string"), "submissions")
    df = spark.createDataFrame([("1", "a", "The docs are nice to read")], "id string, subreddit string, body string")
    row = tx.prepare(df, "comments", ["the"], {"docs": "doc"}).first()
    assert row["tokens"] == ["doc", "are", "nice", "to", "read"] and row["token_count"] == 5


def test_term_statistics(spark):
    df = spark.createDataFrame([(["a", "b", "a"],), (["a"],)], "tokens array<string>")
    got = {r["term"]: (r["total_count"], r["doc_count"]) for r in tx.term_statistics(df).collect()}
    assert got == {"a": (3, 2), "b": (1, 1)}


def test_lemma_table_reaches_rows_without_moving_them(spark, monkeypatch):
    rows = [(i, [f"w{(i * k) % 97}" for k in range(20)] + [None]) for i in range(50)] + [(50, None), (51, [])]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    table = spark.createDataFrame([(f"w{k}", f"l{k % 7}") for k in range(60)] + [("w3", "a"), (None, "b"), ("w5", None)], "form string, lemma string")
    lemmas = {f"w{k}": f"l{k % 7}" for k in range(60)} | {"w3": "a"}
    want = {i: t and [lemmas.get(w, w) for w in t] for i, t in rows}
    got = tx.lemmatise_by_join(df, table)
    plan = got._jdf.queryExecution().optimizedPlan()
    assert "Join" not in plan.toString().split("Subquery")[0].split("scalar-subquery")[0] and "xxhash64(tokens" not in plan.toString()
    assert {r["id"]: r["tokens"] for r in got.collect()} == want
    for limit in (58, 5):  # all forms that occur fit, and do not
        monkeypatch.setattr(tx, "LOOKUP_FORMS", limit)
        assert {r["id"]: r["tokens"] for r in tx.lemmatise_by_join(df, table).collect()} == want

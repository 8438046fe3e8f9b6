"""The spark-submit jobs on tables written from the smallest test data."""

import pytest

from forumlens.jobs import eda, ingest, models, nlp
from forumlens.ml import features
from forumlens.operators import topics as tp
from forumlens.sources import readers
from forumlens.sources import sample_tables as st


@pytest.fixture(scope="module")
def archive(spark, sf_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("archive"))
    st.comments(spark, sf_dir).drop("event_id").write.parquet(f"{folder}/comments")
    st.submissions(spark, sf_dir).drop("event_id").write.parquet(f"{folder}/submissions")
    return folder


def test_eda_tables_have_rows(spark, archive):
    for name, df in eda.tables(spark, archive).items():
        assert df.columns and df.count() > 0 or name == "duplicate_ids", name


def test_nlp_tables_have_rows(spark, archive):
    survey = spark.createDataFrame([("Increased productivity", 31.0)], "benefit string, percentage double")
    tables = nlp.tables(spark, archive, ["happy", "excited"], ["bad", "hate"], ["wrong", "rant"], survey)
    for name, df in tables.items():
        assert df.count() > 0, name
    words = {r["word"] if "word" in r else r[1] for r in tables["profanity_top"].collect()}
    assert words & {"wrong", "rant"} and not words & {"bad", "hate"}


def test_model_tables_have_rows(spark, archive):
    topics = nlp.topic_tables(spark, archive, min_df=2)
    assert topics["topic_vocabulary"].first()["terms_kept"] > 0
    comments = readers.read_parquet(spark, f"{archive}/comments")
    posts = tp.attach_topics(features.comment_features(comments), topics["document_topics"])
    _, tables = models.engagement(posts, min_df=2)
    tables |= models.users(topics["document_topics"], topics["topic_terms"])
    assert posts.count() <= comments.count()
    for name, df in tables.items():
        assert df.count() > 0, name


def test_ingest_command_filters_and_counts(spark, archive, tmp_path, monkeypatch):
    monkeypatch.setattr("sys.argv", ["ingest", archive, str(tmp_path / "out")])
    ingest.main()
    kept = readers.read_parquet(spark, f"{tmp_path}/out/comments")
    assert 0 < kept.count() <= readers.read_parquet(spark, f"{archive}/comments").count()


def test_eda_command_writes_csv(spark, archive, tmp_path, monkeypatch):
    monkeypatch.setattr("sys.argv", ["eda", archive, str(tmp_path), "--only", "monthly_activity"])
    eda.main()
    back = readers.read_csv(spark, f"{tmp_path}/monthly_activity", "year_month string, c long, s long, t long")
    assert back.count() > 0

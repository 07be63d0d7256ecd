from __future__ import annotations

import datetime

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import CountVectorizer, IDF, StringIndexer
from pyspark.sql import functions as F

from tagloom.functions import tokenize
from tagloom.operators import features, metrics, results, sketches, trends
from tagloom.operators.questions import prepare_questions, text_and_tags, training_corpus, with_type
from tagloom.operators.split import train_test_split, with_part
from tagloom.operators.users import build_users_dim
from tagloom.schemas import LABELED_QUESTIONS, POST_TYPES, POSTS, USERS, USERS_DIM


def post(id, type=1, body="<p>Some words</p>", tags="<a><b>", **more):
    row = {"id": id, "PostTypeId": type, "Body": body, "Tags": tags, "Title": f"t{id}", **more}
    return tuple(row.get(name) for name in POSTS.fieldNames())


@pytest.fixture(scope="module")
def types(spark):
    return spark.createDataFrame([(1, "Question"), (2, "Answer")], POST_TYPES)


@pytest.fixture(scope="module")
def posts(spark):
    rows = [
        post(1),
        post(2, type=2),
        post(3, type=None),
        post(4, body=None),
        post(5, tags=None),
        post(6, tags=""),
        post(7, type=9),
        post(8, body="a b a", tags="<c>"),
        post(8, body="a b a", tags="<c>"),
    ]
    return spark.createDataFrame(rows, POSTS)


def test_only_questions_with_a_body_are_prepared(posts, types):
    prepared = prepare_questions(posts, types)
    assert sorted(r.question_id for r in prepared.collect()) == [1, 5, 6, 8, 8]
    assert {"LastEditorDisplayName", "ParentId", "Body", "id"}.isdisjoint(prepared.columns)
    assert with_type(posts, types).count() == 7


def test_empty_tags_are_rows_but_no_topic(posts, types):
    prepared = prepare_questions(posts, types)
    assert sorted((r.question_id, r.tag) for r in text_and_tags(prepared).collect()) == [
        (1, "a"),
        (1, "b"),
        (6, ""),
        (8, "c"),
        (8, "c"),
    ]
    assert "" not in {r.tag for r in training_corpus(posts, types).collect()}


def test_split_keeps_questions_together_and_ignores_partitions(spark):
    rows = spark.range(5000).select(F.col("id").cast("int").alias("question_id")).crossJoin(spark.range(2))
    train, test = (
        {r.question_id for r in part.select("question_id").collect()} for part in train_test_split(rows.repartition(7))
    )
    assert train.isdisjoint(test) and len(train) + len(test) == 5000
    assert 0.88 < len(train) / 5000 < 0.92
    again = with_part(rows.coalesce(1)).filter("part = 'test'").select("question_id").distinct()
    assert {r.question_id for r in again.collect()} == test


# --- results -----------------------------------------------------------------------


def test_duplicate_questions_do_not_multiply(posts, types):
    prepared = prepare_questions(posts, types)
    predictions = prepared.select("question_id", "Text", F.lit(1.0).alias("prediction"), F.lit("c").alias("decoded"))
    merged = results.merge_predictions(predictions, prepared)
    assert sorted(r.question_id for r in merged.collect()) == [1, 5, 6, 8, 8]
    assert set(merged.columns) == {*prepared.columns, "prediction", "decoded"}


def test_a_prediction_without_its_question_is_kept(spark, posts, types):
    lost = spark.createDataFrame([(77, "gone", 0.0, "a")], "question_id int, Text string, prediction double, decoded string")
    (row,) = results.merge_predictions(lost, prepare_questions(posts, types)).collect()
    assert (row.question_id, row.Text, row.Title) == (77, "gone", None)


def test_one_id_with_two_texts_keeps_each_with_its_own_prediction(spark, types):
    rows = spark.createDataFrame([post(1, body="x"), post(1, body="y")], POSTS)
    prepared = prepare_questions(rows, types)
    predictions = prepared.select("question_id", "Text", F.lit(0.0).alias("prediction"), F.col("Text").alias("decoded"))
    merged = results.merge_predictions(predictions, prepared)
    assert sorted((r.Text, r.decoded) for r in merged.collect()) == [("x", "x"), ("y", "y")]


def test_labeled_rows_have_the_table_schema(posts, types):
    tagged = prepare_questions(posts, types).withColumns({"prediction": F.lit(2.0), "decoded": F.lit("a")})
    labeled = results.labeled_questions(tagged, "2023_10_22_02")
    assert [(f.name, f.dataType) for f in labeled.schema] == [(f.name, f.dataType) for f in LABELED_QUESTIONS]
    row = labeled.first()
    assert row.prediction == 2 and row.batch_datetime_stamp == datetime.datetime(2023, 10, 22, 2)


def test_as_of_gives_the_latest_batch_of_each_question(spark):
    rows = [(1, "a", 1), (2, "a", 1), (1, "b", 2), (1, "b", 2), (3, "c", 3), (2, "c", 3), (None, "d", 4)]
    labeled = spark.createDataFrame(rows, "question_id int, decoded string, h int").select(
        "question_id", "decoded", F.make_timestamp(F.lit(2023), F.lit(1), F.lit(1), "h", F.lit(0), F.lit(0)).alias(results.BATCH)
    )
    state = lambda moment: sorted((r.question_id, r.decoded) for r in results.as_of(labeled, moment).collect())
    assert state("2023-01-01 00:30:00") == []
    assert state("2023-01-01 01:30:00") == [(1, "a"), (2, "a")]
    assert state("2023-01-01 02:30:00") == [(1, "b"), (1, "b"), (2, "a")]
    assert state("2023-01-01 03:00:00") == [(1, "b"), (1, "b"), (2, "c"), (3, "c")]
    history = [(r["rows"], r.questions) for r in results.batch_history(labeled).orderBy(results.BATCH).collect()]
    assert history == [(2, 2), (2, 1), (2, 2), (1, 0)]
    assert "d" in {r.decoded for r in results.as_of(labeled, "2023-01-01 05:00:00").collect()}


def test_users_dim(spark):
    row = (1, 40, datetime.date(2011, 5, 6), "n", 1, "hash", "l", 5, 2, 3, "url", 9)
    dim = build_users_dim(spark.createDataFrame([row], USERS), "2023_10_22_02")
    assert dim.columns == USERS_DIM.fieldNames()
    assert tuple(dim.first()) == (1, row[2], 2011, 5, "n", 1, "l", 5, 2, 3, 9, datetime.datetime(2023, 10, 22, 2))


# --- metrics -----------------------------------------------------------------------


def test_metrics_equal_the_library_evaluator(spark):
    pairs = [(i % 5, (i * i) % 7) for i in range(200)] + [(6, 6), (8, 1)]
    rows = spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "label double, prediction double")
    ours = metrics.evaluate(rows, "label", "prediction").first()
    library = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    assert ours["rows"] == 202
    assert ours.weighted_f1 == pytest.approx(library.evaluate(rows))
    assert ours.accuracy == pytest.approx(library.setMetricName("accuracy").evaluate(rows))


def test_any_tag_counts_a_question_once(spark):
    scored = spark.createDataFrame(
        [(1, ["a", "b"], "b"), (2, ["a"], "b"), (3, ["c"], None), (4, None, "a")],
        "question_id int, Tags array<string>, decoded string",
    )
    assert tuple(metrics.any_tag_accuracy(scored).first()) == (3, pytest.approx(1 / 3))


# --- features ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def prepared(spark):
    texts = ["the cat sat", "cat cat dog", "dog and bird", "bird", "", "cat bird dog", "cat fish"]
    tags = [["p", "q"], ["q"], ["p"], None, ["r"], ["q", "r", ""], ["q"]]
    rows = [(i, text, tag) for i, (text, tag) in enumerate(zip(texts, tags))]
    return spark.createDataFrame(rows, "question_id int, Text string, Tags array<string>")


def exploded(prepared):
    rows = text_and_tags(prepared).filter("tag <> ''")
    kept = F.filter(tokenize("Text"), lambda t: ~t.isin("the", "and"))
    return rows.withColumn("Filtered", kept)


def test_terms_and_idf_equal_the_library_on_exploded_rows(prepared):
    rows = exploded(prepared)
    counts = CountVectorizer(inputCol="Filtered", outputCol="c").fit(rows)
    weights = IDF(inputCol="c", outputCol="f", minDocFreq=3).fit(counts.transform(rows))
    library = dict(zip(counts.vocabulary, zip(weights.docFreq, weights.idf.toArray())))
    # The library stores 0 as the frequency of a term below the minimum.
    ours = {r.term: (r.df if r.df >= 3 else 0, r.idf) for r in features.idf_weights(prepared, 3).collect()}
    assert {t: (d, pytest.approx(w)) for t, (d, w) in library.items()} == ours

    totals = rows.select(F.explode("Filtered").alias("term")).groupBy("term").count().collect()
    ranked = features.term_frequency(prepared).orderBy("term_index").collect()
    expected = sorted((-r["count"], r.term) for r in totals)
    assert [(-r.n, r.term) for r in ranked] == expected


def test_label_index_equals_the_library(spark):
    rows = spark.createDataFrame([(t,) for t in "b a c c d d e".split()], "tag string")
    library = StringIndexer(inputCol="tag", outputCol="i").fit(rows).labels
    ours = features.label_index(rows).orderBy("label_index").collect()
    assert [r.tag for r in ours] == library == ["c", "d", "a", "b", "e"]


def test_hashed_frequencies_add_up(prepared):
    hashed = features.hashing_tf(prepared).groupBy("question_id").agg(F.sum("frequency").alias("n"))
    tokens = features.filtered_tokens(prepared).groupBy("question_id").agg(F.count("*").cast("double").alias("n"))
    assert sorted(map(tuple, hashed.collect())) == sorted(map(tuple, tokens.collect()))


# --- trends ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def daily(spark):
    rows = [("2023-01-01", "a", 3), ("2023-01-01", "b", 1), ("2023-01-02", "a", 5), ("2023-01-04", "a", 2)]
    return spark.createDataFrame(rows, "day string, topic string, n long").withColumn("day", F.to_date("day"))


def test_trend_compares_with_the_day_before_only(daily):
    trend = {(str(r.day)[-1], r.topic): (r.previous_n, r.change, r.share) for r in trends.topic_trend(daily).collect()}
    assert trend == {("1", "a"): (0, 3, 0.75), ("1", "b"): (0, 1, 0.25), ("2", "a"): (3, 2, 1.0), ("4", "a"): (0, 2, 1.0)}


def test_trend_keeps_questions_without_a_day(spark):
    undated = spark.createDataFrame([(None, "a", 2), (None, "b", 2)], "day date, topic string, n long")
    assert sorted((r.topic, r.share, r.previous_n) for r in trends.topic_trend(undated).collect()) == [
        ("a", 0.5, 0),
        ("b", 0.5, 0),
    ]


def test_top_topics_break_ties_by_name(spark, daily):
    tied = daily.union(spark.createDataFrame([("c", 3)], "topic string, n long").select(F.to_date(F.lit("2023-01-01")), "topic", "n"))
    first = trends.top_topics_daily(tied, 2).filter("day = '2023-01-01'").orderBy("rank").collect()
    assert [(r.topic, r["rank"]) for r in first] == [("a", 1), ("c", 2)]


def test_engagement_counts_unknown_owners(spark):
    tagged = spark.createDataFrame(
        [("a", 1, 2, 0, None, 1.0, 10), ("a", 1, 4, 0, 3, 2.0, 20), ("a", None, 0, 0, None, 0.0, 0), ("b", 9, 1, 1, 1, 1.0, 1)],
        "topic string, OwnerUserId int, AnswerCount int, CommentCount int, FavoriteCount int, Score float, ViewCount int",
    )
    users = spark.createDataFrame([(1, 50)], "id int, Reputation int")
    found = {r.topic: r for r in trends.engagement_by_topic(tagged, users).collect()}
    a, b = found["a"], found["b"]
    assert (a.questions, a.total_AnswerCount, a.mean_AnswerCount, a.mean_FavoriteCount) == (3, 6.0, 2.0, 3.0)
    assert (a.owners, a.known_owners, a.mean_owner_reputation) == (1, 1, 50.0)
    assert (b.owners, b.known_owners, b.mean_owner_reputation) == (1, 0, None)


# --- areas under curves --------------------------------------------------------------


def test_areas_equal_the_library(spark):
    rows = spark.range(4000).select(
        (F.col("id") % 3).cast("string").alias("topic"), (F.hash("id") % 50 / 7).alias("score"), (F.hash("id", F.lit(1)) % 5 + F.hash("id") % 50 / 10 > 1).alias("hit")
    )
    counts = metrics.score_counts(rows, "score", F.col("hit"), "topic")
    for frame in (counts, counts.repartition(7), counts.coalesce(1)):
        found = {r.topic: r for r in metrics.area_under_curve(frame, "topic").collect()}
        assert set(found) == {"0", "1", "2"}
        for topic, row in found.items():
            own = rows.filter(F.col("topic") == topic).select("score", F.col("hit").cast("double").alias("label"))
            library = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0).evaluate(own)
            assert row.auc == pytest.approx(library, abs=1e-9) and row.positives + row.negatives == own.count()


def test_areas_of_ties_nulls_and_one_sided_groups(spark):
    rows = [("tie", 1.0, True), ("tie", 1.0, False), ("best", 2.0, True), ("best", None, False), ("worst", None, True), ("worst", 0.0, False),
            ("only", 1.0, True), (None, 2.0, True), (None, 1.0, False), ("tie", 9.0, None)]
    scored = spark.createDataFrame(rows, "topic string, score double, hit boolean")
    found = {r.topic: r.auc for r in metrics.area_under_curve(metrics.score_counts(scored, "score", F.col("hit"), "topic"), "topic").collect()}
    assert found == {"tie": 0.5, "best": 1.0, "worst": 0.0, "only": None, None: 1.0}


def test_a_group_of_many_scores_is_dealt_over_tasks(spark):
    counts = spark.range(50_000).select(F.lit("t").alias("topic"), F.col("id").alias("score"), (F.col("id") % 2).alias("positives"), (1 - F.col("id") % 2).alias("negatives"))
    (row,) = metrics.area_under_curve(counts, "topic").collect()
    assert row.auc == pytest.approx(0.5 + 1 / 50_000) and row.positives == 25_000


# --- mergeable distinct counts ---------------------------------------------------------


def test_merged_sketches_keep_their_error(spark, tmp_path):
    rows = spark.range(60_000).select((F.col("id") % 30).alias("day"), (F.hash("id") % 20_000).alias("owner"), F.lit(None).cast("int").alias("none"))
    sketches.sketches(rows, ["day"], owners="owner", none="none").write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    for first, last in ((0, 0), (3, 9), (0, 29)):
        within = F.col("day").between(first, last)
        exact = rows.filter(within).agg(F.countDistinct("owner")).first()[0]
        found = sketches.merged(stored.filter(within).withColumn("all", F.lit(1)), ["all"], "owners", "none").first()
        assert abs(found.owners - exact) <= exact * sketches.error_bound() and found.none == 0

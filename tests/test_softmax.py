"""The regression of several classes against MLlib's own, and what its passes read and send."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tagloom.config import TrainingSettings
from tagloom.operators import softmax, topic_model
from tagloom.operators.softmax import SoftmaxRegression

FEATURES, CLASSES = 120, 6


@pytest.fixture(scope="module")
def examples(spark):
    """Rows of one to three labels each: empty ones, stored zeros, a feature that all share and dense vectors among them."""
    rng, rows = np.random.default_rng(5), []
    chances = np.arange(FEATURES, 0, -1) / np.arange(FEATURES + 1).sum()
    for i in range(400):
        found = np.unique(np.append(rng.choice(FEATURES, rng.integers(0, 30), p=chances), 0)) if i % 40 else np.array([], int)
        vector = Vectors.sparse(FEATURES, found.tolist(), (rng.integers(0, 4, len(found)) * 1.5 + (found == 0)).tolist())
        vector = Vectors.dense(vector.toArray()) if i % 50 == 7 else vector
        for _ in range(1 + i % 3):
            label = len(found) % CLASSES if rng.random() < 0.5 else int(rng.integers(CLASSES))
            rows.append((vector, float(label), float(rng.integers(1, 4))))
    return spark.createDataFrame(rows, ["features", "label", "weight"]).repartition(5).cache()


@pytest.mark.parametrize("sizes", [{}, {"BLOCK_ROWS": 7, "HELD": 100, "DENSE_ROWS": 3}, {"BLOCK_VALUES": 50, "DENSE_FEATURES": 0}, {"DENSE_SHARE": 0.0}])
@pytest.mark.parametrize("settings", [{"maxIter": 30}, {"maxIter": 12, "weightCol": "weight", "family": "multinomial", "tol": 1e-3}])
def test_a_fit_is_that_of_the_library(examples, monkeypatch, tmp_path, sizes, settings):
    for name, value in sizes.items():
        monkeypatch.setattr(softmax, name, value)
    found, known = SoftmaxRegression(**settings).fit(examples), LogisticRegression(**settings).fit(examples)
    assert np.allclose(found.summary.objectiveHistory, known.summary.objectiveHistory, rtol=1e-9, atol=0)
    assert found.summary.totalIterations == known.summary.totalIterations
    assert np.allclose(found.coefficientMatrix.toArray(), known.coefficientMatrix.toArray(), rtol=1e-5, atol=1e-6)
    assert np.allclose(found.interceptVector.toArray(), known.interceptVector.toArray(), rtol=1e-5, atol=1e-6)
    assert found.summary.accuracy == pytest.approx(known.summary.accuracy)
    found.write().overwrite().save(str(tmp_path / "m"))
    stored = LogisticRegressionModel.load(str(tmp_path / "m"))
    assert (stored.numClasses, stored.numFeatures) == (CLASSES, FEATURES)
    assert np.array_equal(stored.coefficientMatrix.toArray(), found.coefficientMatrix.toArray())


def test_it_stops_where_the_library_does(spark):
    """Labels that say nothing about the features: the optimizer converges long before its last iteration."""
    rng = np.random.default_rng(2)
    rows = [(Vectors.sparse(8, [int(f)], [1.0]), float(rng.integers(3))) for f in rng.integers(8, size=600)]
    frame = spark.createDataFrame(rows, ["features", "label"]).repartition(3).cache()
    found, known = (kind(maxIter=200).fit(frame).summary for kind in (SoftmaxRegression, LogisticRegression))
    assert found.totalIterations == known.totalIterations < 200
    assert np.allclose(found.objectiveHistory, known.objectiveHistory, rtol=1e-9, atol=0)


def test_other_models_are_left_to_the_library(spark, examples, monkeypatch):
    monkeypatch.setattr(softmax, "minimize", None)
    two = examples.filter("label < 2")
    assert SoftmaxRegression(maxIter=2).fit(two).numClasses == 2
    assert SoftmaxRegression(maxIter=2, regParam=0.1).fit(examples).numClasses == CLASSES
    assert SoftmaxRegression(maxIter=2, family="multinomial").fit(examples.filter("label = 3")).numClasses == 4
    with pytest.raises(Exception):
        SoftmaxRegression(maxIter=2).fit(examples.withColumn("label", F.col("label") + 0.5))


def test_a_text_is_read_once_for_all_of_its_tags(spark, monkeypatch):
    """The passes of the fit hold one row per question, and send one gradient per core, whatever the partitions are."""
    text = F.concat(F.lit("common w"), (F.col("id") % 50).cast("string"), F.lit(" v"), F.col("id").cast("string"))
    tags = F.array(*[F.concat(F.lit(t), F.col("id") % 3) for t in "abc"], F.lit(""))
    questions = spark.range(0, 1000, 1, 32).select(text.alias("Text"), tags.alias("Tags"))
    one_pass, seen = softmax._pass, []

    def watched(blocks, *args):
        if not seen:
            seen.append((blocks.getNumPartitions(), blocks.map(lambda block: block[0]).sum(), blocks.map(lambda block: len(block[1][0])).sum()))
        return one_pass(blocks, *args)

    monkeypatch.setattr(softmax, "_pass", watched)
    topic_model.fit_topic_model(questions, TrainingSettings(vocabulary=2048, max_iterations=2, min_doc_freq=0, partitions=32))
    assert seen == [(spark.sparkContext.defaultParallelism, 1000, 3000)]

"""MLlib's multinomial regression with passes that read a text once for all of its tags.

MLlib multiplies each row with the coefficients of one class after the other, and a text with two tags is two rows. Here
neighbouring rows of equal features are one row with several labels, the commonest features are a dense matrix, the others
are gathered with all classes at once. Objective, scaling, start, optimizer and the stored model are MLlib's; what
this does not cover (a penalty, bounds, two classes, a single label) is left to MLlib.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import DenseMatrix, Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.operators.lbfgs import minimize

# Executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A feature is dense if it stands in so large a share of the rows; there are at most so many.
DENSE_SHARE, DENSE_FEATURES = 1 / 16, 512
#: Most rows and values of a block, and numbers that are summed at once where its values meet the residuals.
BLOCK_ROWS, BLOCK_VALUES, HELD = 2048, 1 << 18, 1 << 15
#: Rows of a dense matrix.
DENSE_ROWS = 512
#: Rows that go to a Python worker at once; texts may be long.
ARROW_ROWS = 250
ARROW_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _together(classes: int) -> int:
    """Features whose sums over all classes are held at once."""
    return max(16, HELD // classes)


def _joined(batches: Iterator, rows: int) -> Iterator[pa.RecordBatch]:
    """Small batches together, so many rows or ``BLOCK_VALUES`` values."""
    held, size, values = [], 0, 0
    for batch in batches:
        held.append(batch)
        size, values = size + batch.num_rows, values + len(batch.column(0).flatten())
        if size >= rows or values >= BLOCK_VALUES:
            yield pa.concat_batches(held)
            held, size, values = [], 0, 0
    if size:
        yield pa.concat_batches(held)


def _merged(offsets: np.ndarray, indices: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each row whether it has the same features as the row before."""
    lengths = np.diff(offsets)
    same_length = np.append(False, lengths[1:] == lengths[:-1])
    row = np.repeat(np.arange(len(lengths)), lengths)
    at = np.flatnonzero(same_length[row])
    before = at - lengths[row[at]]
    equal = (indices[at] == indices[before]) & (values[at] == values[before])
    return same_length & (np.bincount(row[at], equal, len(lengths)) == lengths)


def _block(lengths: np.ndarray, indices: np.ndarray, values: np.ndarray, labels: tuple, dense: int, together: int) -> tuple:
    """One block: its labels as ``row, class, weight``, places and values of the dense part, the other part by row, and by feature.

    By feature, the values stand in layers: of so many features ``together`` the first value of each, then the second of those that
    have two, and so on. Features of many values come first, so a layer is a prefix of the one before.
    """
    rows = len(lengths)
    row = np.repeat(np.arange(rows, dtype=np.int32), lengths)
    common = indices < dense
    places = row[common] * np.int32(dense) + indices[common]
    row, indices, rare = row[~common], indices[~common], values[~common]
    order = np.argsort(indices, kind="stable")
    features, starts, held = np.unique(indices[order], return_index=True, return_counts=True)
    falling = np.argsort(-held, kind="stable")
    place = np.empty(len(features), np.int64)
    place[falling] = np.arange(len(features))
    place = np.repeat(place, held)
    layer = np.arange(len(order)) - np.repeat(starts, held)
    order = order[np.lexsort((place % together, layer, place // together))].astype(np.int32)
    small = np.uint16 if len(indices) == 0 or indices.max() < 1 << 16 else np.int32
    counts = np.bincount(row, minlength=rows).astype(np.int32)
    by_feature = order, row[order].astype(np.uint16), features[falling].astype(np.int32), held[falling].astype(np.int32)
    return rows, labels, (places, values[common]), (counts, indices.astype(small), rare), by_feature


def blocks_of(batches: Iterator, rank: np.ndarray, scale: np.ndarray, dense: int, classes: int) -> Iterator[tuple]:
    """Blocks of Arrow batches of ``indices, values, label, weight``; features are numbered by ``rank`` and scaled."""
    most = max(1, min(BLOCK_ROWS, (1 << 20) // classes))
    for batch in _joined(batches, most):
        lists, flat = batch.column(0), batch.column(0).flatten().to_numpy(zero_copy_only=False)
        offsets = lists.offsets.to_numpy()
        offsets = (offsets - offsets[0]).astype(np.int64)
        numbers = batch.column(1).flatten().to_numpy(zero_copy_only=False)
        label, weight = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
        new = ~_merged(offsets, flat, numbers)
        group = np.cumsum(new) - 1
        starts, ends = offsets[:-1][new], offsets[1:][new]
        first = np.flatnonzero(new)
        a = 0
        while a < len(starts):
            # As many rows as a block holds, one at least.
            size = np.cumsum(ends[a : a + most] - starts[a : a + most])
            b = a + max(1, int(np.searchsorted(size, BLOCK_VALUES, side="right")))
            lengths = ends[a:b] - starts[a:b]
            at = np.repeat(starts[a:b] - np.append(0, np.cumsum(lengths)[:-1]), lengths) + np.arange(lengths.sum())
            indices, values = flat[at], numbers[at] * scale[flat[at]]
            kept = values != 0
            lengths = np.bincount(np.repeat(np.arange(b - a), lengths)[kept], minlength=b - a)
            rows = slice(first[a], first[b] if b < len(first) else len(label))
            labels = ((group[rows] - a).astype(np.int32), label[rows].astype(np.int32), weight[rows].astype(np.float64))
            yield _block(lengths, rank[indices[kept]], values[kept], labels, dense, _together(classes))
            a = b


def add_block(block: tuple, weights: np.ndarray, offset: np.ndarray, dense: int, gradient: np.ndarray) -> tuple[float, np.ndarray]:
    """Add a block's gradient to ``gradient`` (features by classes); returns its loss and the sums of its residuals."""
    rows, (row, label, weight), (places, common), (counts, indices, rare), (order, by_row, features, held) = block
    classes = len(offset)
    margins = np.tile(offset, (rows, 1))
    tiles = []
    for a in range(0, rows if dense else 0, DENSE_ROWS):
        b = min(rows, a + DENSE_ROWS)
        first, last = np.searchsorted(places, (a * dense, b * dense))
        tiles.append((a, b, places[first:last] - a * dense, common[first:last]))
    for a, b, at, values in tiles:
        matrix = np.zeros((b - a, dense))
        matrix.ravel()[at] = values
        margins[a:b] += matrix @ weights[:dense]
    ends = np.cumsum(counts)
    for r in np.flatnonzero(counts).tolist():
        a, b = ends[r] - counts[r], ends[r]
        margins[r] += rare[a:b] @ weights.take(indices[a:b], axis=0)
    margins -= margins.max(axis=1)[:, None]
    own = margins[row, label]
    residuals = np.exp(margins, out=margins)
    totals = residuals.sum(axis=1)
    loss = float(weight.dot(np.log(totals)[row] - own))
    residuals *= (np.bincount(row, weight, rows) / totals)[:, None]
    np.subtract.at(residuals, (row, label), weight)
    for a, b, at, values in tiles:
        matrix = np.zeros((b - a, dense))
        matrix.ravel()[at] = values
        gradient[:dense] += matrix.T @ residuals[a:b]
    layered, together, at = rare[order][:, None], _together(classes), 0
    buffer = np.empty((together, classes))
    for i in range(0, len(held), together):
        some = held[i : i + together]
        sums = np.zeros((len(some), classes))
        for n in (len(some) - np.searchsorted(some[::-1], np.arange(some[0]), side="right")).tolist():
            spread = residuals.take(by_row[at : at + n], axis=0, out=buffer[:n], mode="clip")
            spread *= layered[at : at + n]
            sums[:n] += spread
            at += n
        gradient[features[i : i + together]] += sums
    return loss, residuals.sum(axis=0)


def _stored_blocks(rows: DataFrame, rank: np.ndarray, scale: np.ndarray, dense: int, classes: int) -> RDD:
    """The blocks of ``x, y, w``, kept for the passes of the fit, on disk where needed."""
    vector = F.unwrap_udt("x")
    values = vector.getField("values")
    indices = F.coalesce(vector.getField("indices"), F.sequence(F.lit(0), F.size(values) - 1))

    def packed(batches: Iterator) -> Iterator:
        for block in blocks_of(batches, rank, scale, dense, classes):
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block, protocol=5)], pa.binary())], ["block"])

    conf = rows.sparkSession.conf
    before = conf.get(ARROW_SETTING)
    conf.set(ARROW_SETTING, min(int(before), ARROW_ROWS) if int(before) > 0 else ARROW_ROWS)
    try:
        stored = rows.select(indices.alias("indices"), values.alias("values"), "y", "w").mapInArrow(packed, "block binary").rdd
    finally:
        conf.set(ARROW_SETTING, before)
    return stored.map(lambda row: pickle.loads(row.block)).persist(StorageLevel.MEMORY_AND_DISK)


def _pass(blocks: RDD, sent, shape: tuple[int, int], dense: int, tasks: int, out: np.ndarray) -> tuple[float, np.ndarray]:
    """Loss and residuals over all blocks; their gradient goes to ``out``. Each task sends on its gradient in slices, which are summed apart."""
    features, classes = shape
    edges = [features * k // tasks for k in range(tasks + 1)]

    def partial(found: Iterator[tuple]) -> Iterator[tuple[int, np.ndarray]]:
        weights, offset = sent.value
        gradient, tail = np.zeros(shape), np.zeros(1 + classes)
        for block in found:
            loss, residuals = add_block(block, weights, offset, dense, gradient)
            tail[0] += loss
            tail[1:] += residuals
        for k in range(tasks):
            yield k, gradient[edges[k] : edges[k + 1]]
        yield tasks, tail

    summed = blocks.mapPartitions(partial).reduceByKey(lambda a, b: a + b, tasks)
    for k, part in summed.collect():
        if k == tasks:
            tail = part
        else:
            out[edges[k] : edges[k + 1]] = part
    _forget_shuffle(summed)
    return float(tail[0]), tail[1:]


def _forget_shuffle(rdd: RDD) -> None:
    """Delete the files of the shuffle before ``rdd``, which else stay until the driver collects its garbage: a fit makes a hundred."""
    cleaner = rdd.context._jsc.sc().cleaner()
    node = rdd._jrdd.rdd()
    while cleaner.isDefined() and not node.dependencies().isEmpty():
        before = node.dependencies().head()
        if before.getClass().getSimpleName() == "ShuffleDependency":
            cleaner.get().doCleanupShuffle(before.shuffleId(), True)
            return
        node = before.rdd()


class SoftmaxRegression(LogisticRegression):
    """``LogisticRegression``; see the module."""

    def _fit(self, dataset: DataFrame) -> LogisticRegressionModel:
        weight = F.col(self.getWeightCol()).cast("double") if self.isDefined(self.weightCol) and self.getWeightCol() else F.lit(1.0)
        rows = dataset.select(F.col(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"), weight.alias("w"))
        histogram = self._histogram(dataset, rows) if self._covers() else None
        if histogram is None:
            return super()._fit(dataset)
        stats = rows.select(Summarizer.metrics("mean", "std", "numNonZeros", "count").summary(F.col("x"), F.col("w")).alias("s")).first().s
        mean, std, held = (stats[name].toArray() for name in ("mean", "std", "numNonZeros"))
        scale = np.divide(1.0, std, out=np.zeros_like(std), where=std != 0)
        # Features are numbered by falling frequency, so that the dense ones come first and the common ones lie together.
        common = np.argsort(-held, kind="stable")
        dense = int((held[common[:DENSE_FEATURES]] >= DENSE_SHARE * stats["count"]).sum())
        rank = np.empty(len(std), np.int32)
        rank[common] = np.arange(len(std), dtype=np.int32)
        blocks = _stored_blocks(rows, rank, scale, dense, len(histogram))
        try:
            found, history = self._optimize(blocks, (mean * scale)[common], histogram, dense)
        finally:
            blocks.unpersist()
        return self._model(dataset, found[:-1][rank] * scale[:, None], found[-1] - (mean * scale)[common] @ found[:-1], history)

    def _covers(self) -> bool:
        bounds = (self.lowerBoundsOnCoefficients, self.upperBoundsOnCoefficients, self.lowerBoundsOnIntercepts, self.upperBoundsOnIntercepts)
        plain = self.getRegParam() == 0 and self.getFitIntercept() and not any(self.isSet(bound) for bound in bounds)
        return plain and self.getFamily().lower() in ("auto", "multinomial")

    def _histogram(self, dataset: DataFrame, rows: DataFrame) -> np.ndarray | None:
        """Weight of each class; none if MLlib would not fit several classes to it, or refuse it."""
        found = rows.groupBy("y").agg(F.sum("w").alias("w"), F.min(F.coalesce("w", F.lit(-1.0))).alias("least")).collect()
        if any(r.y is None or r.y < 0 or r.y != int(r.y) or r.least < 0 for r in found) or sum(r.w > 0 for r in found) < 2:
            return None
        named = dataset.schema[self.getLabelCol()].metadata.get("ml_attr", {})
        known = named.get("num_vals", len(named.get("vals", ())))
        seen = 1 + int(max(r.y for r in found))
        if (known and known < seen) or (self.getFamily().lower() == "auto" and max(known, seen) <= 2):
            return None
        histogram = np.zeros(max(known, seen))
        for r in found:
            histogram[int(r.y)] = r.w
        return histogram

    def _optimize(self, blocks: RDD, means: np.ndarray, histogram: np.ndarray, dense: int) -> tuple[np.ndarray, list[float]]:
        """Coefficients of scaled and centred features by class, intercepts in the last row, and the objective at each iteration."""
        sc, (features, classes), total = blocks.context, (len(means), len(histogram)), histogram.sum()
        # Each task sends on a gradient, so there are no more of them than cores.
        tasks = min(sc.defaultParallelism, blocks.getNumPartitions())
        dealt = blocks.coalesce(tasks)
        start = np.zeros((features + 1, classes))
        start[-1] = np.log1p(histogram)
        start[-1] -= start[-1].mean()

        def objective(point: np.ndarray, gradient: np.ndarray) -> float:
            x, out = (v.reshape(features + 1, classes) for v in (point, gradient))
            sent = sc.broadcast((x[:-1], x[-1] - means @ x[:-1]))
            try:
                loss, residuals = _pass(dealt, sent, (features, classes), dense, tasks, out[:-1])
            finally:
                sent.destroy()
            for c in range(classes):
                out[:-1, c] -= means * residuals[c]
            out[-1] = residuals
            out /= total
            return loss / total

        found, history = minimize(objective, start.ravel(), self.getMaxIter(), self.getTol())
        return found.reshape(features + 1, classes), history

    def _model(self, dataset: DataFrame, coefficients: np.ndarray, intercepts: np.ndarray, history: list[float]) -> LogisticRegressionModel:
        """The model that MLlib makes of them: without a penalty, coefficients and intercepts are centred over the classes."""
        features, classes = coefficients.shape
        coefficients = coefficients - coefficients.mean(axis=1)[:, None]
        matrix = DenseMatrix(classes, features, coefficients.T.ravel(), isTransposed=True)
        sc = dataset.sparkSession.sparkContext
        package = sc._jvm.org.apache.spark.ml.classification
        vector = Vectors.dense(intercepts - intercepts.mean())
        java = package.LogisticRegressionModel(self.uid, _py2java(sc, matrix).compressed(), _py2java(sc, vector).compressed(), classes, True)
        model = self._copyValues(LogisticRegressionModel(java))
        model._transfer_params_to_java()
        objective = sc._gateway.new_array(sc._jvm.double, len(history))
        for i, value in enumerate(history):
            objective[i] = float(value)
        weight = self.getWeightCol() if self.isDefined(self.weightCol) else "weightCol"
        columns = (self.getProbabilityCol(), self.getPredictionCol(), self.getLabelCol(), self.getFeaturesCol(), weight)
        summary = package.LogisticRegressionTrainingSummaryImpl(java.transform(dataset._jdf), *columns, objective)
        java.setSummary(sc._jvm.scala.Option.apply(summary))
        return model

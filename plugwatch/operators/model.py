"""Training and evaluation of the logistic model.

The model has few features, so it is fitted by Newton steps: one pass over the rows sums the
gradient and the curvature by matrix products, and the driver solves a system of as many equations
as there are weights. Spark's own
estimator scales features to unit variance inside; with an unscaled penalty that makes scores
of tiny variance, such as the danger score, so stiff that its line search fails.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plugwatch.session import stored
from plugwatch.settings import MODEL_CLASSES, MODEL_FEATURES


def label_of(columns: Sequence[str]) -> Column:
    """Name of the one-hot column with the largest value, the first one on ties."""
    largest = F.greatest(*[F.col(c) for c in columns]) if len(columns) > 1 else F.col(columns[0])
    return reduce(
        lambda rest, c: F.when(F.col(c) == largest, c).otherwise(rest),
        reversed(columns), F.lit(None).cast("string"))


class TrainedModel:
    """Weights of a fitted model, with its classes in alphabetical order.

    ``weights`` has one row per output: the second class of two, or every class of more. The
    last value of a row is the intercept.
    """

    def __init__(self, features: Sequence[str], classes: Sequence[str], weights):
        self.features, self.classes, self.weights = list(features), list(classes), weights

    @property
    def outputs(self) -> list[str]:
        return self.classes[1:] if len(self.classes) == 2 else self.classes

    def coefficients(self) -> list[dict]:
        """One row per output: its class, the weights and the intercept."""
        return [
            {"class": name, **dict(zip([*self.features, "intercept"], map(float, row)))}
            for name, row in zip(self.outputs, self.weights)
        ]

    def coefficient_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [tuple(r.values()) for r in self.coefficients()],
            ", ".join(["class string", *[f"{f} double" for f in self.features],
                       "intercept double"]))

    def with_probabilities(self, df: DataFrame) -> DataFrame:
        """Add ``probability``, an array in the order of the outputs."""
        logits = [
            " + ".join([f"{row[-1]!r}D", *[f"CAST(`{f}` AS DOUBLE) * {w!r}D"
                                           for f, w in zip(self.features, row)]])
            for row in self.weights.tolist()
        ]
        if len(logits) == 1:
            return df.withColumn("probability", F.expr(f"array(1 / (1 + exp(-({logits[0]}))))"))
        # The largest logit is taken off, so that no exponential overflows.
        raised = "transform(z, x -> exp(x - array_max(z)))"
        return df.withColumn("probability", F.expr(
            f"transform(array(array({', '.join(logits)})), z -> transform({raised},"
            f" e -> e / aggregate({raised}, 0D, (total, x) -> total + x)))[0]"))

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``probability``, per class, and ``predicted_class``, the most likely one."""
        scored = self.with_probabilities(df)
        if len(self.outputs) == 1:
            scored = scored.withColumn(
                "probability", F.array(1 - F.col("probability")[0], F.col("probability")[0]))
        names = F.array(*[F.lit(c) for c in self.classes])
        best = F.array_position("probability", F.array_max("probability"))
        return scored.withColumn(
            "predicted_class", F.get(names, best.cast("int") - 1))


def _partial_sums(columns: list[str], classes: list[str], outputs: list[str], weights, width: int):
    """Loss, gradient and curvature of a partition's rows, one row: blocks of rows at a time."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        k = len(outputs)
        loss, gradient, curvature = 0.0, np.zeros((k, width)), np.zeros((k, width, k, width))
        for batch in batches:
            x = np.column_stack([batch.column(c).to_numpy() for c in columns] + [np.ones(batch.num_rows)])
            label = batch.column("true_class").to_numpy(zero_copy_only=False)
            z = x @ weights.T
            x = x[:, :width]
            if k == 1:
                p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
                own = np.where(label == outputs[0], p[:, 0], 1 - p[:, 0])
            else:
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                own = p[np.arange(len(label)), np.searchsorted(classes, label)]
            y = np.column_stack([label == c for c in outputs]).astype(float)
            loss -= np.log(np.maximum(own, 1e-300)).sum()
            gradient += (p - y).T @ x
            for a in range(k):
                for b in range(k):
                    curvature[a, :, b] += (x * (p[:, a] * ((a == b) - p[:, b]))[:, None]).T @ x
        yield pa.RecordBatch.from_arrays([pa.array(
            [np.concatenate([[loss], gradient.ravel(), curvature.ravel()])], pa.list_(pa.float64()))], ["sums"])

    return run


# Tasks whose sums the driver adds up itself.
FEW_TASKS = 64


def _sums(model: TrainedModel, rows: DataFrame, terms: int, tasks: int):
    """Loss, gradient and curvature of the model over all rows, for the first ``terms`` of the
    features and the intercept.

    Each task sums blocks of rows by matrix products. The sums of many tasks are added up in groups
    of about the square root of their number, so the driver adds as many.
    """
    import numpy as np

    def added(batches):
        import pyarrow as pa

        sums = [np.asarray(row.values) for batch in batches for row in batch.column(0)]
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array([sum(sums)], pa.list_(pa.float64()))], ["sums"])

    k = len(model.outputs)
    part = rows.mapInArrow(_partial_sums(
        model.features, model.classes, model.outputs, np.asarray(model.weights), terms), "sums array<double>")
    if tasks > FEW_TASKS:
        part = part.repartition(round(tasks ** 0.5)).mapInArrow(added, "sums array<double>")
    total = sum(np.array(r[0]) for r in part.collect())
    return total[0], total[1:1 + k * terms], total[1 + k * terms:].reshape(k * terms, k * terms)


def residuals(model: TrainedModel, rows: DataFrame, classes: Sequence[str] = MODEL_CLASSES,
              intercept: bool = False) -> DataFrame:
    """How far the model is from the optimum: ``class``, ``feature`` and ``residual``, the slope of
    the penalised loss there, which is zero at the optimum. Computed by column expressions, apart
    from the sums of the training. Takes the rows of :func:`train`."""
    outputs, names = model.outputs, [*model.features, *(["intercept"] if intercept else [])]
    # Stored, so that the probabilities are not computed again for each feature.
    data = stored(model.with_probabilities(_training_data(rows, model.features, classes)).select(
        F.array(*[F.col(f"`{f}`") for f in model.features], *([F.lit(1.0)] if intercept else [])).alias("x"),
        F.array(*[F.col("probability")[i] - (F.col("true_class") == c).cast("double")
                  for i, c in enumerate(outputs)]).alias("miss")))
    slopes = data.select("miss", F.posexplode("x").alias("at", "value")).groupBy("at").agg(
        *[F.sum(F.col("miss")[i] * F.col("value")).alias(f"slope_{i}") for i in range(len(outputs))])
    weights = rows.sparkSession.createDataFrame(
        [(i, j, c, f, 0.0 if f == "intercept" and j == len(model.features) else float(w))
         for i, (c, of) in enumerate(zip(outputs, model.weights.tolist()))
         for j, (f, w) in enumerate(zip(names, of))],
        "output int, at int, class string, feature string, weight double")
    slope = F.element_at(F.array(*[f"slope_{i}" for i in range(len(outputs))]), F.col("output") + 1)
    return weights.join(slopes, "at").select("class", "feature", (slope + F.col("weight")).alias("residual"))


def _training_data(rows: DataFrame, features: Sequence[str], classes: Sequence[str]) -> DataFrame:
    """The features as doubles and the label, of rows that have all of them."""
    data = rows.select(*[F.col(f).cast("double").alias(f) for f in features],
                       label_of(classes).alias("true_class"))
    return data.replace(float("nan"), None, subset=list(features)).dropna()


def train(rows: DataFrame, features: Sequence[str] = MODEL_FEATURES,
          classes: Sequence[str] = MODEL_CLASSES, intercept: bool = False,
          max_steps: int = 100, tolerance: float = 1e-8) -> TrainedModel:
    """Fit a logistic model with an L2 penalty of weight 1 on the sum of the losses.

    The intercept is not penalised. The rows are stored first, as each step reads them; rows without
    a label or with a feature that is null or no number are left out. Training that has not
    converged after ``max_steps`` is an error.
    """
    import numpy as np

    data = stored(_training_data(rows, features, classes))
    present = sorted(r[0] for r in data.select("true_class").distinct().collect())
    if len(present) < 2:
        raise ValueError(f"training needs rows of at least two classes, found {present}")
    model = TrainedModel(features, present, None)
    k, width = len(model.outputs), len(features) + 1
    terms, tasks = len(features) + bool(intercept), data.rdd.getNumPartitions()
    penalty = np.tile([1.0] * len(features) + ([0.0] if intercept else []), k)

    def at(values) -> TrainedModel:
        weights = np.zeros((k, width))
        weights[:, :terms] = values.reshape(k, terms)
        return TrainedModel(features, present, weights)

    beta, step, last_loss = np.zeros(k * terms), np.zeros(k * terms), np.inf
    for _ in range(max_steps):
        loss, gradient, curvature = _sums(at(beta), data, terms, tasks)
        loss += 0.5 * float(penalty @ beta**2)
        if loss > last_loss + 1e-9 * abs(last_loss):  # too far: go back half the step
            step = step / 2
            beta = beta - step
            continue
        last_loss = loss
        # Least squares, as equal shifts of all intercepts change nothing with many classes.
        step = -np.linalg.lstsq(
            curvature + np.diag(penalty), gradient + penalty * beta, rcond=None)[0]
        beta = beta + step
        if np.abs(step).max() < tolerance:
            return at(beta)
    raise ValueError(f"training has not converged after {max_steps} steps")


def confusion_counts(predictions: DataFrame) -> DataFrame:
    """Rows per true and predicted class."""
    return predictions.groupBy("true_class", "predicted_class").agg(
        F.count(F.lit(1)).alias("rows"))


def class_report(predictions: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class; 0 where a rate is undefined."""
    counts = confusion_counts(predictions)
    hit = F.when(F.col("true_class") == F.col("predicted_class"), F.col("rows")).otherwise(0)
    # One row per class and role, so that a class that is only predicted appears as well.
    roles = counts.select("rows", hit.alias("hits"), F.explode(F.array(
        F.struct(F.col("true_class").alias("class"), F.lit(True).alias("is_true")),
        F.struct(F.col("predicted_class").alias("class"), F.lit(False).alias("is_true")),
    )).alias("role")).select("rows", "hits", "role.*")

    def zero_if_undefined(c: Column) -> Column:
        return F.coalesce(c, F.lit(0.0))

    per_class = roles.groupBy("class").agg(
        F.sum(F.when(F.col("is_true"), F.col("hits")).otherwise(0)).alias("_hits"),
        F.sum(F.when(F.col("is_true"), F.col("rows")).otherwise(0)).alias("support"),
        F.sum(F.when(~F.col("is_true"), F.col("rows")).otherwise(0)).alias("_predicted"),
    ).withColumns({
        "precision": zero_if_undefined(F.try_divide("_hits", "_predicted")),
        "recall": zero_if_undefined(F.try_divide("_hits", "support")),
    })
    f1 = F.try_divide(2 * F.col("precision") * F.col("recall"),
                      F.col("precision") + F.col("recall"))
    return per_class.select("class", "precision", "recall", zero_if_undefined(f1).alias("f1"),
                            "support")


def metrics(predictions: DataFrame) -> DataFrame:
    """One row: accuracy, and precision, recall and F1 as plain means over the classes.

    Accuracy is the recall of the classes weighted by their support.
    """
    return class_report(predictions).agg(
        F.try_divide(F.sum(F.col("recall") * F.col("support")), F.sum("support"))
        .alias("accuracy"),
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
    )


def confusion_matrix(predictions: DataFrame, classes: Sequence[str]) -> DataFrame:
    """One row per true class, one count column per predicted class."""
    return confusion_counts(predictions).groupBy("true_class").agg(*[
        F.coalesce(F.sum(F.when(F.col("predicted_class") == c, F.col("rows"))), F.lit(0))
        .alias(c) for c in classes
    ])


def mismatched(predictions: DataFrame) -> DataFrame:
    return predictions.where(F.col("true_class") != F.col("predicted_class"))


def evaluate(model: TrainedModel, rows: DataFrame,
             classes: Sequence[str] = MODEL_CLASSES) -> tuple[DataFrame, DataFrame]:
    """Metrics of the model on labelled rows, and the rows it gets wrong."""
    predictions = model.predict(rows.withColumn("true_class", label_of(classes)))
    return metrics(predictions), mismatched(predictions)

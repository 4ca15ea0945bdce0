"""The pair matcher as a Spark ML pipeline, fitted and judged by groups."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kuatia.operators.pairs import components
from kuatia.session import stage

FEATURES = ["similarity", "shared_per", "shared_org", "shared_loc", "entity_jaccard"]


def balanced(df: DataFrame, label: str) -> DataFrame:
    """df with ``weight``: each class counts as much as the other."""
    n = {bool(r[label]): r["count"] for r in df.groupBy(label).count().collect()}
    total = sum(n.values())
    weights = {k: total / (len(n) * v) for k, v in n.items()}
    return df.withColumn("weight", F.when(F.col(label), weights.get(True, 1.0)).otherwise(weights.get(False, 1.0)))


def fit(df: DataFrame, label: str = "same", features: list[str] = FEATURES, strength: float = 1.0) -> PipelineModel:
    """Standardised features and a logistic regression, penalised as by ``strength`` over the sum of losses."""
    rows = balanced(df, label).withColumn("_y", F.col(label).cast("double"))
    n = max(rows.count(), 1)
    stages = [VectorAssembler(inputCols=features, outputCol="_raw"), StandardScaler(inputCol="_raw", outputCol="_x", withMean=True), LogisticRegression(featuresCol="_x", labelCol="_y", weightCol="weight", probabilityCol="_p", maxIter=200, regParam=1 / (strength * n), standardization=False)]
    return Pipeline(stages=stages).fit(rows)


def scored(model: PipelineModel, df: DataFrame, out: str = "probability") -> DataFrame:
    return model.transform(df).withColumn(out, vector_to_array("_p")[1]).drop("_raw", "_x", "_p", "rawPrediction", "prediction")


def coefficients(model: PipelineModel, features: list[str] = FEATURES) -> list[tuple[str, float]]:
    """Features with their coefficients, strongest first."""
    return sorted(zip(features, model.stages[-1].coefficients.toArray().tolist()), key=lambda x: -abs(x[1]))


def out_of_fold(df: DataFrame, fold: str, folds: int, label: str = "same", features: list[str] = FEATURES) -> DataFrame:
    """Every row scored by the model fitted without its fold; null where the other folds hold only one class."""
    out, fitted = None, False
    for i in range(folds):
        rest, held = df.where(F.col(fold) != i), df.where(F.col(fold) == i)
        both = rest.select(label).distinct().count() >= 2
        part = scored(fit(rest, label, features), held) if both else held.withColumn("probability", F.lit(None).cast("double"))
        out, fitted = part if out is None else out.unionByName(part), fitted or both
    if not fitted:
        raise ValueError("no fold leaves both classes")
    return out


#: Components that are dealt to folds by size; the many smaller ones go by a hash.
DEALT = 1000
#: Feature sets that are compared.
FEATURE_SETS = {"similarity": ["similarity"], "entities": ["shared_per", "shared_org", "shared_loc", "entity_jaccard"], "jaccard": ["similarity", "entity_jaccard"], "all": FEATURES}


def group_folds(df: DataFrame, a: str = "a", b: str = "b", label: str = "same", folds: int = 5, dealt: int = DEALT) -> DataFrame:
    """df with ``component`` and ``fold``: every pair is an edge, so no article is in two folds.

    The ``dealt`` largest components are dealt back and forth in order of their
    positive pairs, which keeps folds alike in size and in share of positives; the
    rest, far more but small, go by a hash.
    """
    comp = stage(components(df, a, b), "fold-components")
    rows = df.join(comp.select(F.col("node").alias(a), "component"), a)
    sizes = stage(rows.groupBy("component").agg(F.count_if(F.col(label)).alias("pos"), F.count(F.lit(1)).alias("n")), "fold-sizes")
    large = sizes.orderBy(F.desc("n"), "component").limit(dealt)
    place = F.row_number().over(Window.orderBy(F.desc("pos"), F.desc("n"), "component")) - 1  # at most ``dealt`` rows
    turn = F.pmod(place, F.lit(2 * folds))
    fixed = large.select(F.col("component").alias("c"), F.least(turn, 2 * folds - 1 - turn).alias("f"))
    return rows.join(F.broadcast(fixed), F.col("component") == F.col("c"), "left").withColumn("fold", F.coalesce(F.col("f").cast("long"), F.pmod(F.xxhash64("component"), F.lit(folds)))).drop("c", "f")


def zoo(trees: int = 50, seed: int = 42) -> dict:
    """Classifiers by name, each for the columns _x, _y and weight."""
    columns = {"featuresCol": "_x", "labelCol": "_y", "weightCol": "weight"}
    return {
        "logistic": LogisticRegression(**columns, maxIter=200, standardization=False), "forest": RandomForestClassifier(**columns, numTrees=trees, seed=seed),
        "boosted": GBTClassifier(**columns, maxIter=max(1, trees // 5), seed=seed),
    }


def compared(df: DataFrame, fold: str, folds: int, label: str = "same", models: dict | None = None, sets: dict[str, list[str]] = FEATURE_SETS, threshold: float = 0.5) -> DataFrame:
    """(model, features, folds, mean and both deviations of precision and recall) of every model and feature set over grouped folds."""
    from kuatia.operators.metrics import over_folds

    df, out = stage(df, "compared"), None
    for name, model in (models or zoo()).items():
        for title, features in sets.items():
            parts = None
            for i in range(folds):
                rest, held = df.where(F.col(fold) != i), df.where(F.col(fold) == i)
                if rest.select(label).distinct().count() < 2:
                    continue  # a fold whose rest holds one class has no model; it counts in no mean
                rows = balanced(rest, label).withColumn("_y", F.col(label).cast("double"))
                stages = [VectorAssembler(inputCols=features, outputCol="_raw"), StandardScaler(inputCol="_raw", outputCol="_x", withMean=True), model]
                part = Pipeline(stages=stages).fit(rows).transform(held).select(fold, label, vector_to_array("probability")[1].alias("p"))
                parts = part if parts is None else parts.unionByName(part)
            if parts is not None:
                one = over_folds(parts, fold, "p", label, threshold).select(F.lit(name).alias("model"), F.lit(title).alias("features"), "*")
                out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no fold leaves both classes")
    return out


def save(model: PipelineModel, path: str, features: list[str] = FEATURES, **notes) -> None:
    """The model at path/model, and what it was made from as one JSON row at path/about, in the shared file system."""
    import json

    from pyspark.sql import SparkSession

    model.write().overwrite().save(f"{path}/model")
    about = {"features": features, "coefficients": dict(coefficients(model, features)), **notes}
    SparkSession.active().createDataFrame([(json.dumps(about, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")


def load(path: str) -> tuple[PipelineModel, dict]:
    import json

    from pyspark.sql import SparkSession

    return PipelineModel.load(f"{path}/model"), json.loads(SparkSession.active().read.text(f"{path}/about").first()["value"])

"""Boosted-tree risk model: training, evaluation and scoring."""

from __future__ import annotations

from collections.abc import Sequence

import json
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from onsetlab.operators.boosting import BoostedTrees, BoostingOptions, train_boosted
from onsetlab.sources import versions
from onsetlab.sources.staging import Stages

LABEL = "target"
KEYS = ("person_id", "disease_start_date")
RANGES = 256
CUTS_A_HEAD = 16

# Depth, learning rate, row sampling and number of rounds. The
# lower bound on rows per leaf follows from the bound of 6 on a leaf's summed
# Hessian, since the logistic loss has at most 0.25 per row. The split penalty
# is on another scale here and is left at 0.
PARAMETERS = {
    "maxDepth": 5,
    "stepSize": 0.2,
    "minInfoGain": 0.0,
    "minInstancesPerNode": 24,
    "subsamplingRate": 0.7,
    "lossType": "logistic",
    "maxIter": 10,
    "seed": 42,
}


def feature_columns(df: DataFrame) -> list[str]:
    """All columns of a matrix but its label and keys."""
    return [c for c in df.columns if c != LABEL and c not in KEYS]


def with_filled_features(df: DataFrame, features: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Features without gaps: a missing number becomes 0, and a column says that it was missing."""
    cells, names = {}, []
    for name in features:
        cells[f"{name}_filled"] = F.coalesce(F.col(name).cast("double"), F.lit(0.0))
        cells[f"{name}_missing"] = F.col(name).isNull().cast("double")
        names += [f"{name}_filled", f"{name}_missing"]
    return df.withColumns(cells), names


def train(
    df: DataFrame, features: Sequence[str] | None = None, **parameters
) -> PipelineModel:
    """Fit the model on a training matrix; ``parameters`` override the defaults.

    Features may be missing: no row is left out for that, in training or scoring.
    """
    filled, names = with_filled_features(df, list(features or feature_columns(df)))
    assembler = VectorAssembler(inputCols=names, outputCol="features")
    trees = GBTClassifier(labelCol=LABEL, featuresCol="features", **{**PARAMETERS, **parameters})
    return Pipeline(stages=[assembler, trees]).fit(filled)


def train_second_order(
    df: DataFrame,
    features: Sequence[str] | None = None,
    options: BoostingOptions = BoostingOptions(),
    stages: Stages | None = None,
) -> BoostedTrees:
    """Grow boosted trees by gradients and Hessians on a training matrix."""
    return train_boosted(df, list(features or feature_columns(df)), LABEL, options, stages)


Model = PipelineModel | BoostedTrees


def model_features(model: Model) -> list[str]:
    """The matrix columns that a trained model reads."""
    if isinstance(model, BoostedTrees):
        return model.features
    return [c.removesuffix("_filled") for c in model.stages[0].getInputCols() if c.endswith("_filled")]


def with_risk(model: Model, df: DataFrame) -> DataFrame:
    """``df`` and each row's ``risk``, the probability of the event."""
    check_columns(df, model_features(model))
    if isinstance(model, BoostedTrees):
        return df.select("*", model.risk().alias("risk"))
    filled, names = with_filled_features(df, model_features(model))
    risk = vector_to_array("probability").getItem(1).alias("risk")
    return model.transform(filled).select(*df.columns, risk)


def check_columns(df: DataFrame, features: Sequence[str]) -> None:
    """An error that names the columns a model reads and a matrix does not have."""
    if missing := [c for c in features if c not in df.columns]:
        raise ValueError(f"the model reads columns that are not there: {', '.join(missing)}")


def score(model: Model, df: DataFrame) -> DataFrame:
    """The keys of ``df`` and each row's ``risk``, the probability of the event."""
    keys = [c for c in KEYS if c in df.columns]
    return with_risk(model, df).select(*keys, "risk")


CONFUSION = (
    ("true_positive", 1, 1),
    ("false_positive", 0, 1),
    ("false_negative", 1, 0),
    ("true_negative", 0, 0),
)


def score_metrics(
    df: DataFrame, score_col: str = "risk", label_col: str = LABEL, threshold: float = 0.5
) -> DataFrame:
    """How well scores tell labels apart, as ``metric, name, value`` rows.

    Metrics: the four confusion counts, where a score above ``threshold`` says 1,
    and the exact areas under the ROC and the precision-recall curve, from the
    counts per distinct score. Equal scores are one step of either curve; the
    precision-recall curve begins at recall 0 with its first precision. Areas are
    NULL unless both labels occur; rows without a label or score do not count.

    No score is binned, whatever their number: running totals over all scores
    are those within a range of scores plus the totals of the ranges above.
    """
    y, x = F.col(label_col).cast("int"), F.col(score_col).cast("double")
    counts = (
        df.where(y.isNotNull() & x.isNotNull())
        .groupBy(x.alias("x"))
        .agg(F.count_if(y == 1).alias("p"), F.count_if(y == 0).alias("n"))
    )
    above = F.col("x") > threshold
    totals = counts.agg(
        *[
            F.coalesce(F.sum(F.when(above if said else ~above, F.col("p" if actual else "n"))), F.lit(0)).alias(name)
            for name, actual, said in CONFUSION
        ]
    )
    areas = _areas(counts)
    rows = [F.struct(F.lit("confusion").alias("metric"), F.lit(n).alias("name"), F.col(n).cast("double").alias("value")) for n, _, _ in CONFUSION]
    rows += [
        F.struct(F.lit("area").alias("metric"), F.lit(n).alias("name"), F.col(n).alias("value"))
        for n in ("areaUnderROC", "areaUnderPR")
    ]
    return totals.crossJoin(areas).select(F.inline(F.array(*rows)))


def ranged(counts: DataFrame) -> DataFrame:
    """``counts`` of scores ``x`` with each score's range ``part``; ranges hold about as many scores each."""
    steps = [i / RANGES for i in range(1, RANGES)]
    cuts = counts.agg(F.array_distinct(F.percentile_approx("x", steps, 100 * RANGES)).alias("cuts"))
    # The range of a score is the number of cuts below it, found in two steps of sixteen.
    coarse = F.size(F.filter("heads", lambda cut: cut < F.col("x")))
    first = F.greatest(coarse - 1, F.lit(0)) * CUTS_A_HEAD
    fine = F.size(F.filter(F.slice("cuts", first + 1, CUTS_A_HEAD), lambda cut: cut < F.col("x")))
    heads = F.filter("cuts", lambda cut, at: at % CUTS_A_HEAD == 0)
    return counts.crossJoin(F.broadcast(cuts.select("cuts", heads.alias("heads")))).select(
        "x", "p", "n", (first + fine).alias("part")
    )


def _areas(counts: DataFrame) -> DataFrame:
    """One row with the areas under both curves, from label counts per score.

    Scores are cut into ranges with about as many distinct scores each, however
    they cluster, at quantiles of the distinct scores. The quantiles are
    approximate and only say how the work is divided: running totals need the
    totals of the ranges above, of which there are RANGES, and a window within
    a range, so the areas are exact wherever the cuts lie.
    """
    placed = ranged(counts)
    sums = placed.groupBy("part").agg(F.sum("p").alias("ps"), F.sum("n").alias("ns"))
    higher = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    before = sums.select(
        "part",
        F.coalesce(F.sum("ps").over(higher), F.lit(0)).alias("p_before"),
        F.coalesce(F.sum("ns").over(higher), F.lit(0)).alias("n_before"),
        F.sum("ps").over(whole).alias("p_all"),
        F.sum("ns").over(whole).alias("n_all"),
    )
    here = Window.partitionBy("part").orderBy(F.desc("x")).rowsBetween(Window.unboundedPreceding, -1)
    curve = placed.join(F.broadcast(before), "part").select(
        "p", "n", "p_all", "n_all",
        (F.col("p_before") + F.coalesce(F.sum("p").over(here), F.lit(0))).cast("double").alias("tp"),
        (F.col("n_before") + F.coalesce(F.sum("n").over(here), F.lit(0))).cast("double").alias("fp"),
    )
    hit, seen = F.col("tp") + F.col("p"), F.col("tp") + F.col("fp") + F.col("p") + F.col("n")
    precision = hit / seen
    earlier = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(precision)
    roc = F.sum(F.col("n") * (F.col("tp") + F.col("p") / 2)) / F.max(F.col("p_all") * F.col("n_all").cast("double"))
    pr = F.sum(F.col("p") * (precision + earlier) / 2) / F.max("p_all")
    both = F.min(F.least("p_all", "n_all")) > 0
    return curve.agg(F.when(both, roc).alias("areaUnderROC"), F.when(both, pr).alias("areaUnderPR"))


def evaluate(model: Model, df: DataFrame) -> DataFrame:
    """Quality of a model on labelled rows, as ``metric, name, value`` rows.

    The rows of :func:`score_metrics` for the model's risks, and the importance
    of each feature: that of its number and of its being missing together.
    """
    metrics = score_metrics(with_risk(model, df).select(LABEL, "risk"))
    importances: dict[str, float] = {}
    if isinstance(model, BoostedTrees):
        importances = model.importances()
    else:
        assembler, trees = model.stages
        for name, value in zip(assembler.getInputCols(), trees.featureImportances.toArray()):
            feature = name.removesuffix("_filled").removesuffix("_missing")
            importances[feature] = importances.get(feature, 0.0) + float(value)
    rows = [("importance", name, value) for name, value in importances.items()]
    listed = df.sparkSession.createDataFrame(rows, "metric string, name string, value double")
    return metrics.unionByName(listed)


FORMAT = 1


@dataclass(frozen=True)
class SavedModel:
    """A model read back, the matrix columns it reads and the options of its job."""

    model: Model
    features: list[str]
    options: dict

    def score(self, df: DataFrame) -> DataFrame:
        """:func:`score`, after checking that the matrix has the model's columns."""
        return score(self.model, df)


def save_model(spark: SparkSession, model: Model, path: str, options: dict | None = None, keep: int = 1) -> None:
    """Write a model with its columns and options as the current version at ``path``.

    The old version stays what is read until the new one is whole, and ``keep``
    older ones stay after that.
    """
    folder = versions.new_folder(path)
    facts = {"format": FORMAT, "features": model_features(model), "options": options or {}}
    if isinstance(model, BoostedTrees):
        facts |= {"kind": "second_order", "trees": json.loads(model.to_json())}
    else:
        facts["kind"] = "pipeline"
        model.write().save(f"{folder}/pipeline")
    if not versions.write_once(spark, f"{folder}/model.json", json.dumps(facts)):
        raise RuntimeError(f"{folder} is in use")
    versions.commit(spark, path, folder, {"features": len(facts["features"])}, keep)


def load_model(spark: SparkSession, path: str) -> SavedModel:
    """The current model at ``path``."""
    folder = versions.current_folder(spark, path)
    if folder is None:
        raise FileNotFoundError(f"no model at {path}")
    facts = json.loads(versions.read_text(spark, f"{folder}/model.json"))
    if facts["format"] != FORMAT:
        raise ValueError(f"{path} has format {facts['format']}, this reads {FORMAT}")
    if facts["kind"] == "second_order":
        model: Model = BoostedTrees.from_json(json.dumps(facts["trees"]))
    else:
        model = PipelineModel.load(f"{folder}/pipeline")
    if model_features(model) != facts["features"]:
        raise ValueError(f"the model at {path} does not read the columns it was saved with")
    return SavedModel(model, facts["features"], facts["options"])

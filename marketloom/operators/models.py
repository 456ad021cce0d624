"""Propensity and uplift models with Spark ML, and scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any, NamedTuple

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Imputer, ImputerModel, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.operators.datasets import stratified_cap
from marketloom.operators.evaluation import calibration_bins, classification_metrics, overlap_diagnostics
from marketloom.sources.shared import discard, materialise


def feature_manifest(frame: DataFrame, excluded: set[str]) -> list[dict[str, Any]]:
    """Ordered features with their types and whether they are categories."""
    return [{"name": f.name, "type": f.dataType.simpleString(), "categorical": f.dataType.simpleString() == "string"} for f in frame.schema if f.name not in excluded]


def require_manifest(frame: DataFrame, manifest: list[dict[str, Any]]) -> None:
    """An error unless the frame has every feature with its type."""
    have = {f.name: f.dataType.simpleString() for f in frame.schema}
    if wrong := [m["name"] for m in manifest if have.get(m["name"]) != m["type"]]:
        raise ValueError(f"features missing or of another type: {wrong}")


def _stages(manifest: list[dict[str, Any]]) -> tuple[list, str]:
    text = [m["name"] for m in manifest if m["categorical"]]
    numbers = [m["name"] for m in manifest if not m["categorical"]]
    stages: list = []
    if text:
        stages.append(StringIndexer(inputCols=text, outputCols=[f"_i_{c}" for c in text], handleInvalid="keep"))
    if numbers:
        stages.append(Imputer(inputCols=numbers, outputCols=[f"_n_{c}" for c in numbers]))
    stages.append(VectorAssembler(inputCols=[f"_i_{c}" for c in text] + [f"_n_{c}" for c in numbers], outputCol="_features", handleInvalid="keep"))
    return stages, "_features"


def _as_double(frame: DataFrame, manifest: list[dict[str, Any]]) -> DataFrame:
    return frame.withColumns({m["name"]: F.col(m["name"]).cast("double") for m in manifest if not m["categorical"]})


def _with_features(rows: DataFrame, prepare: PipelineModel) -> DataFrame:
    """The rows with the vector that the fitted stages make of them.

    It is one expression on the columns of ``rows``: the stages would add one or two columns for each feature, in a method of
    generated code that is too long for the JVM to compile.
    """
    parts = []
    for stage in prepare.stages:
        if isinstance(stage, StringIndexerModel):
            for c, labels in zip(stage.getInputCols(), stage.labelsArray):
                # At most as many labels as the trees have bins; others and nulls come behind them.
                places = F.create_map(*(F.lit(x) for k, label in enumerate(labels) for x in (label, float(k)))) if labels else None
                other = F.lit(float(len(labels)))
                parts.append(other if places is None else F.coalesce(F.try_element_at(places, F.col(c)), other))
        elif isinstance(stage, ImputerModel):
            means = stage.surrogateDF.first()
            parts += [F.coalesce(F.nanvl(c, F.lit(None).cast("double")), F.lit(means[c])) for c in stage.getInputCols()]
    name = prepare.stages[-1].getOutputCol()
    # Says which features are categories.
    kinds = prepare.transform(rows.limit(0)).schema[name].metadata
    return rows.withColumn(name, array_to_vector(F.array(*parts)).alias(name, metadata=kinds))


def _stopped_early(frame: DataFrame, manifest: list[dict[str, Any]], label: str, split: str, trees: int, depth: int, keep: Sequence[str] = ()) -> tuple[PipelineModel, DataFrame]:
    """Boosted trees, and the stored rows they were fitted on: the features, written once as they are read several times, and columns to keep."""
    stages, features = _stages(manifest)
    trainer = GBTClassifier(featuresCol=features, labelCol=label, maxIter=trees, maxDepth=depth, maxBins=64, seed=7, validationIndicatorCol="_held")
    rows = _as_double(frame, manifest).withColumn("_held", F.col(split) == "validation")
    prepare = Pipeline(stages=stages).fit(rows)
    ready = materialise(_with_features(rows, prepare).select(*dict.fromkeys([*keep, label, "_held", features])))
    return PipelineModel([*prepare.stages, trainer.fit(ready)]), ready


def train_propensity(frame: DataFrame, manifest: list[dict[str, Any]], label: str = "label", split: str = "split", trees: int = 10, depth: int = 4) -> PipelineModel:
    """Boosted trees that stop early on the validation rows."""
    model, ready = _stopped_early(frame, manifest, label, split, trees, depth)
    discard(ready)
    return model


def fitted_scores(frame: DataFrame, manifest: list[dict[str, Any]], keys: list[str], label: str = "label", split: str = "split", trees: int = 10, depth: int = 4) -> DataFrame:
    """Keys (no features) and ``p_base_purchase`` of all rows by the model that ``train_propensity`` fits on them; features are made once for both."""
    model, ready = _stopped_early(frame, manifest, label, split, trees, depth, keys)
    return model.stages[-1].transform(ready).select(*keys, vector_to_array("probability")[1].alias("p_base_purchase"))


class Boosted(NamedTuple):
    """Boosted trees cut to the best number of trees, and the validation loss of every number from 1 on."""

    model: PipelineModel
    best_iteration: int
    losses: list[float]


def boost(frame: DataFrame, manifest: list[dict[str, Any]], label: str, split: str = "split", trees: int = 20, depth: int = 4, weight: str | None = None) -> Boosted:
    """Boosted trees on the train rows, with as many trees as are best on the validation rows.

    All trees are grown, and every prefix of them is judged on the validation rows. If a shorter one is best, as many trees are grown
    again: with the same seed and rows they are the same trees, and the model holds no others.
    """
    stages, features = _stages(manifest)
    rows = _as_double(frame, manifest)
    prepare = Pipeline(stages=stages).fit(rows.where(F.col(split) == "train"))
    ready = materialise(_with_features(rows, prepare).select(features, F.col(label).cast("double").alias(label), split, *([weight] if weight else [])))
    train, held = ready.where(F.col(split) == "train"), ready.where(F.col(split) == "validation")
    trainer = GBTClassifier(featuresCol=features, labelCol=label, maxIter=trees, maxDepth=depth, maxBins=64, seed=7, **({"weightCol": weight} if weight else {}))
    fitted = trainer.fit(train)
    losses = fitted.evaluateEachIteration(held)
    best = min(range(len(losses)), key=losses.__getitem__) + 1
    if best < len(losses):
        fitted = trainer.copy({trainer.maxIter: best}).fit(train)
    discard(ready)
    return Boosted(PipelineModel([*prepare.stages, fitted]), best, losses)


def capped(frame: DataFrame, keys: list[str], most: int, seed: int, split: str = "split") -> DataFrame:
    """All validation rows, and train rows with labels in proportion, at most ``most`` in all."""
    held = frame.where(F.col(split) == "validation")
    room = most - held.count()
    if room < 2:
        raise ValueError("the validation rows leave no room for train rows")
    return stratified_cap(frame.where(F.col(split) == "train"), keys, room, seed).unionByName(held)


def fit_propensity(
    frame: DataFrame, manifest: list[dict[str, Any]], keys: list[str], most: int | None = None, seed: int = 11, trees: int = 20, depth: int = 4, bins: int = 10
) -> tuple[Boosted, DataFrame]:
    """A propensity model and its report on the validation rows, one row.

    The report has the rows used, the best number of trees, AUC, average precision, log loss, Brier score, and the calibration bins. All
    rows are used, and read several times; with ``most`` at most so many, all validation rows among them.
    """
    rows = frame if most is None else materialise(capped(frame, keys, most, seed))
    counts = {r["split"]: (r["n"], r["labels"]) for r in rows.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("label").alias("labels")).collect()}  # two rows
    if any(counts.get(x, (0, 0))[1] != 2 for x in ("train", "validation")):
        raise ValueError("both splits need rows of both labels")
    fitted = boost(rows, manifest, "label", trees=trees, depth=depth)
    held = score_propensity(rows.where("split = 'validation'"), fitted.model, manifest)
    scored = materialise(held.select("label", F.round("p_base_purchase", 6).alias("score")))
    table = calibration_bins(scored, bins).agg(F.sort_array(F.collect_list(F.struct("bin", "n", "mean_score", "positive_rate"))).alias("calibration_bins"))
    sizes = [F.lit(counts[x][0]).alias(f"n_{x}") for x in ("train", "validation")]
    report = classification_metrics(scored).select(*sizes, F.lit(fitted.best_iteration).alias("best_iteration"), F.lit(len(fitted.losses)).alias("iterations"), "*")
    return fitted, report.join(F.broadcast(table), how="cross")  # one row on both sides


def treatment_overlap(frame: DataFrame, manifest: list[dict[str, Any]], trees: int = 20, depth: int = 4) -> DataFrame:
    """How well the features tell who was treated: AUC, best number of trees, quantiles of the fitted probability and the share outside 0.1 to 0.9.

    A classifier of the arm is fitted on the train rows; figures are of the validation rows. Alike arms have an AUC near a half.
    """
    fitted = boost(frame, manifest, "treatment", trees=trees, depth=depth)
    held = _probability(frame.where("split = 'validation'"), fitted.model, manifest, "score").select(F.col("treatment").alias("label"), F.round("score", 6).alias("score"))
    scored = materialise(held)
    out = overlap_diagnostics(scored).join(F.broadcast(classification_metrics(scored).select("roc_auc")), how="cross")
    return out.withColumn("best_iteration", F.lit(fitted.best_iteration))


def arm_report(frame: DataFrame, models: tuple[PipelineModel, PipelineModel], manifest: list[dict[str, Any]], label: str = "target") -> DataFrame:
    """Per arm: its rows, the trees of its model, the weights of its labels in training, and metrics on its own validation rows."""
    weights = {(r["treatment"], r[label]): r["w"] for r in class_weights(frame.where("split = 'train'"), label).groupBy("treatment", label).agg(F.first("_w").alias("w")).collect()}  # four rows
    out = None
    for arm, model in enumerate(models):
        mine = frame.where(F.col("treatment") == arm)
        scored = _probability(mine.where("split = 'validation'"), model, manifest, "score").select(F.col(label).alias("label"), F.round("score", 6).alias("score"))
        sizes = mine.agg(*(F.count_if(F.col("split") == x).alias(f"n_{x}") for x in ("train", "validation")))
        facts = [F.lit(arm).alias("treatment"), F.lit(model.stages[-1].getNumTrees).alias("best_iteration"), *(F.lit(weights.get((arm, y))).cast("double").alias(f"weight_{y}") for y in (0, 1))]
        row = sizes.join(F.broadcast(classification_metrics(scored)), how="cross").select(*facts, "*")
        out = row if out is None else out.unionByName(row)
    return out


def class_weights(frame: DataFrame, label: str, threshold: float = 0.1) -> DataFrame:
    """Add ``_w``: balanced within each arm if label 1 is rarer than the threshold in either arm, else 1.

    One decision holds for both arms, so their probabilities can be compared.
    """
    rates = frame.groupBy("treatment").agg(F.avg(label).alias("_r"))
    # At most two rows.
    rates = rates.join(F.broadcast(rates.agg(F.min("_r").alias("_least"))), how="cross")
    usable = (F.col("_least") < threshold) & (F.col("_r") > 0) & (F.col("_r") < 1)
    balanced = F.when(F.col(label) == 1, 0.5 / F.col("_r")).otherwise(0.5 / (1 - F.col("_r")))
    return frame.join(F.broadcast(rates), "treatment").withColumn("_w", F.when(usable, balanced).otherwise(1.0)).drop("_r", "_least")


def train_t_learner(frame: DataFrame, manifest: list[dict[str, Any]], label: str = "target", trees: int = 10, depth: int = 3) -> tuple[PipelineModel, PipelineModel]:
    """One model of boosted trees per arm, control first, that stops early on the arm's validation rows."""
    train = class_weights(frame.where("split = 'train'"), label)
    rows = _as_double(train.unionByName(frame.where("split = 'validation'").withColumn("_w", F.lit(1.0))), manifest)
    rows = rows.withColumn("_held", F.col("split") == "validation")
    out = []
    for arm in (0, 1):
        stages, features = _stages(manifest)
        trainer = GBTClassifier(featuresCol=features, labelCol=label, weightCol="_w", maxIter=trees, maxDepth=depth, maxBins=64, seed=7, validationIndicatorCol="_held")
        out.append(Pipeline(stages=[*stages, trainer]).fit(rows.where(F.col("treatment") == arm)))
    return out[0], out[1]


def _probability(frame: DataFrame, model: PipelineModel, manifest: list[dict[str, Any]], name: str) -> DataFrame:
    require_manifest(frame, manifest)
    typed = frame.select("*", *(F.col(m["name"]).alias(f"_keep_{m['name']}") for m in manifest))
    ready = _with_features(_as_double(typed, manifest), PipelineModel(model.stages[:-1]))
    scored = model.stages[-1].transform(ready).withColumn("_p", vector_to_array("probability")[1])
    columns = [F.col(f"_keep_{c}").alias(c) if f"_keep_{c}" in scored.columns else F.col(c) for c in frame.columns]
    return scored.select(*columns, F.col("_p").alias(name))


def score_propensity(frame: DataFrame, model: PipelineModel, manifest: list[dict[str, Any]]) -> DataFrame:
    """Add ``p_base_purchase``."""
    return _probability(frame, model, manifest, "p_base_purchase")


def score_uplift(frame: DataFrame, models: tuple[PipelineModel, PipelineModel], manifest: list[dict[str, Any]]) -> DataFrame:
    """Add both arms' probabilities and their difference."""
    out = _probability(frame, models[0], manifest, "p_control")
    out = _probability(out, models[1], manifest, "p_treatment")
    return out.withColumn("uplift_score", F.col("p_treatment") - F.col("p_control"))


def score_with_pandas_model(frame: DataFrame, predict: Callable[[pd.DataFrame], pd.Series], keys: list[str], features: list[str]) -> DataFrame:
    """Scores of an external model, batch by batch; a score outside 0 to 1 is an error."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            p = predict(batch[features])
            if not p.between(0, 1).all():
                raise ValueError("a score is not between 0 and 1")
            yield batch[keys].assign(score=p.to_numpy(float))

    schema = ", ".join(f"{k} {frame.schema[k].dataType.simpleString()}" for k in keys) + ", score double"
    return frame.select(*keys, *features).mapInPandas(score, schema)

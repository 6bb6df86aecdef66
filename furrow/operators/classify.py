"""Classification: training tables, tree ensembles, cross-validation, background threshold and physical rules after scoring."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furrow.functions import series

THRESHOLDS = [round(0.10 + 0.05 * i, 2) for i in range(17)]


def balanced(df: DataFrame, label: str = "label") -> DataFrame:
    """Adds class_weight n / (k * n_c)."""
    per = df.groupBy(label).agg(F.count("*").alias("_n"))
    whole = per.agg(F.sum("_n").alias("_all"), F.count("*").alias("_k"))
    weights = per.crossJoin(F.broadcast(whole)).select(label, (F.col("_all") / (F.col("_k") * F.col("_n"))).alias("class_weight"))
    return df.join(F.broadcast(weights), label)  # a row a class


def folds(df: DataFrame, key: str, label: str = "label", k: int = 5, seed: int = 42) -> DataFrame:
    """Adds fold: stratified by label, drawn by a hash of the key."""
    w = Window.partitionBy(label).orderBy(F.xxhash64(F.lit(seed), F.col(key)), key)
    return df.withColumn("fold", F.pmod(F.row_number().over(w) - 1, F.lit(k)))


def assembled(df: DataFrame, columns: list[str]) -> DataFrame:
    """Adds features; rows with a missing or infinite value are left out."""
    whole = [F.coalesce(F.abs(F.col(c).cast("double")) < float("inf"), F.lit(False)) for c in columns]
    finite = whole[0]
    for w in whole[1:]:
        finite = finite & w
    return VectorAssembler(inputCols=columns, outputCol="features").transform(df.where(finite))


def classifier(kind: str = "random_forest", trees: int = 100, depth: int = 12, seed: int = 42):
    """Random forest with class weights, or boosted trees (one against the rest, with shrinkage and row sampling as a boosted histogram learner has)."""
    if kind == "random_forest":
        return RandomForestClassifier(labelCol="label", featuresCol="features", weightCol="class_weight", numTrees=trees, maxDepth=min(depth, 30), seed=seed)
    if kind == "gradient_boosting":
        return OneVsRest(classifier=GBTClassifier(maxIter=trees, maxDepth=min(depth, 6), seed=seed), labelCol="label", featuresCol="features", weightCol="class_weight")
    if kind == "xgboost":
        return OneVsRest(classifier=GBTClassifier(maxIter=trees, maxDepth=min(depth, 8), stepSize=0.1, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=seed), labelCol="label", featuresCol="features", weightCol="class_weight")
    raise ValueError(f"unknown kind of model: {kind}")


@dataclass
class Scorer:
    """A fitted model, its labels in order, its columns and the background threshold."""

    model: Model
    labels: list[int]
    columns: list[str]
    threshold: float = 0.5

    def probabilities(self, df: DataFrame, out: str = "probs") -> DataFrame:
        """Adds the probability of each label."""
        names = df.columns
        scored = self.model.transform(assembled(df, self.columns))
        if "probability" in scored.columns:
            probs = vector_to_array("probability")
        else:  # one against the rest: margins of each label, through the logistic function, made to sum to 1
            up = F.transform(vector_to_array("rawPrediction"), lambda x: 1 / (1 + F.exp(-2 * x)))
            probs = F.transform(up, lambda x: x / F.greatest(F.aggregate(up, F.lit(0.0), lambda a, b: a + b), F.lit(1e-12)))
        return scored.withColumn(out, probs).select(*names, out)


def fit(df: DataFrame, columns: list[str], kind: str = "random_forest", trees: int = 100, depth: int = 12, seed: int = 42, threshold: float = 0.5) -> Scorer:
    """Fit labels (any integers) on feature columns."""
    labels = sorted(r[0] for r in df.select("label").distinct().collect())  # a row a class
    if not labels:
        raise ValueError("no training rows")
    place = F.array_position(F.array(*(F.lit(x) for x in labels)), F.col("label")) - 1
    ready = assembled(balanced(df), columns).withColumn("label", place.cast("double"))
    return Scorer(classifier(kind, trees, depth, seed).fit(ready), labels, columns, threshold)


def cross_validate(df: DataFrame, columns: list[str], key: str, kind: str = "random_forest", trees: int = 100, depth: int = 12, k: int = 5, seed: int = 42) -> DataFrame:
    """Out-of-fold probabilities: key, label, probs (in the order of the sorted labels). k fits, one a fold."""
    dealt = folds(df, key, k=k, seed=seed).cache()
    out = None
    for f in range(k):
        scorer = fit(dealt.where(F.col("fold") != f), columns, kind, trees, depth, seed)
        part = scorer.probabilities(dealt.where(F.col("fold") == f)).select(key, "label", "probs")
        out = part if out is None else out.unionByName(part)
    return out


def threshold_search(df: DataFrame, background: str = "p_bg", label: str = "label") -> DataFrame:
    """One row: the background threshold (0.10 to 0.90 by 0.05) of best crop F1 (within 1e-4), the one nearest 0.5, and its F1."""
    tried = df.select((F.col(label) > 0).alias("y"), F.col(background).alias("p")).withColumn("th", F.explode(F.array(*(F.lit(t) for t in THRESHOLDS))))
    crop = F.col("p") < F.col("th")
    f1 = 2 * F.count_if(crop & F.col("y")) / F.greatest(2 * F.count_if(crop & F.col("y")) + F.count_if(crop & ~F.col("y")) + F.count_if(~crop & F.col("y")), F.lit(1))
    scores = tried.groupBy("th").agg(f1.alias("f1"))
    best = scores.agg(F.max("f1").alias("best"))
    return scores.crossJoin(F.broadcast(best)).where(F.col("f1") >= F.col("best") - 1e-4).orderBy(F.abs(F.col("th") - 0.5), "th").limit(1).select("th", F.round("f1", 4).alias("f1"))


def vegetated(features: list[Column]) -> Column:
    """The gate before scoring: the greatest of the leading feature columns reaches 0.28."""
    return F.greatest(*features) >= 0.28 if len(features) > 1 else features[0] >= 0.28


def decide(probs: Column, labels: list[int], threshold: float = 0.5) -> tuple[Column, Column]:
    """(code, crop probability): background from the clipped threshold on, else the best crop; without a background class the best."""
    p = lambda i: F.get(probs, F.lit(i))
    def best(places: list[int]) -> Column:
        top = F.greatest(*(p(i) for i in places)) if len(places) > 1 else p(places[0])
        out = F.when(p(places[0]) == top, labels[places[0]])
        for i in places[1:]:
            out = out.when(p(i) == top, labels[i])
        return out
    every = list(range(len(labels)))
    if 0 not in labels:
        return best(every).cast("int"), F.array_max(probs)
    bg = labels.index(0)
    others = [i for i in every if i != bg]
    safe = min(0.60, max(0.40, threshold))
    code = F.when(p(bg) >= safe, 0).otherwise(best(others) if others else F.lit(1))
    return code.cast("int"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - p(bg)))


def implausible(ndvi: Column, n: int, cv_mean: Column | None = None) -> Column:
    """What cannot be a field: never green or never bare, rough canopy, forest, lawn."""
    low, high, wide, mean = F.array_min(ndvi), F.array_max(ndvi), series.span(ndvi), series.mean(ndvi)
    basic = (high >= 0.35) & (low <= 0.45) & (wide >= 0.18)
    forest = (low >= 0.42) & (mean >= 0.55)
    rough = cv_mean > 0.25 if cv_mean is not None else F.lit(False)
    out = ~basic | rough | forest
    if n >= 3:
        v = lambda i: series.at(ndvi, i)
        out = out | ((v(0) >= 0.38) & (v(n // 2) >= 0.65) & (v(n - 1) >= 0.55) & (wide < 0.28)) | ((wide < 0.18) & (high < 0.65))
    return out


def water_locked(ndvi: Column) -> Column:
    return (F.array_max(ndvi) < 0.08) | (F.array_min(ndvi) < -0.15)


def apply_rules(df: DataFrame, ndvi: str, n: int, code: str = "code", prob: str = "crop_prob", cv_mean: str | None = None) -> DataFrame:
    """Implausible crops and water become background with probability 0."""
    v = F.col(ndvi)
    drop = ((F.col(code) > 0) & implausible(v, n, F.col(cv_mean) if cv_mean else None)) | water_locked(v)
    drop = F.coalesce(drop, F.lit(False))
    return df.withColumn("_drop", drop).withColumn(code, F.when(F.col("_drop"), 0).otherwise(F.col(code))).withColumn(prob, F.when(F.col("_drop"), 0.0).otherwise(F.col(prob))).drop("_drop")


def score(df: DataFrame, scorer: Scorer, ndvi: str, n: int, gate: list[str] | None = None, cv_mean: str | None = None) -> DataFrame:
    """Adds code and crop_prob. Pixels below the vegetation gate, or with missing features, are background and never reach the model."""
    names, gate = df.columns, gate or scorer.columns[: min(n + 5, len(scorer.columns))]
    keyed = df.withColumn("_gate", F.coalesce(vegetated([F.col(c) for c in gate]), F.lit(False)))
    code, prob = decide(F.col("probs"), scorer.labels, scorer.threshold)
    scored = scorer.probabilities(keyed.where("_gate")).withColumn("code", code).withColumn("crop_prob", prob).select(*names, "code", "crop_prob")
    finite = None
    for c in scorer.columns:
        ok = F.coalesce(F.abs(F.col(c).cast("double")) < float("inf"), F.lit(False))
        finite = ok if finite is None else finite & ok
    rest = keyed.where(~(F.col("_gate") & finite)).withColumn("code", F.lit(0)).withColumn("crop_prob", F.lit(0.0)).select(*names, "code", "crop_prob")
    return apply_rules(scored.unionByName(rest), ndvi, n, cv_mean=cv_mean)

"""A random forest on tie features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_folder, stage

FEATURES = ("distance_ft", "median_distance", "median_distance_z", "median_mismatch")


def stratified_split(df: DataFrame, label: str, key: str, *, share: float = 0.7, seed: int = 58) -> tuple[DataFrame, DataFrame]:
    """Two parts with equal shares of each label, by rank of a hashed key within approximate quantiles."""
    hashed = df.withColumn("__h", F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 30)).cast("double"))
    cuts = hashed.groupBy(label).agg(F.percentile_approx("__h", share).alias("__cut"))
    both = hashed.join(cuts, label)
    return both.where("__h <= __cut").drop("__h", "__cut"), both.where("__h > __cut").drop("__h", "__cut")


def train_forest(df: DataFrame, *, label: str = "label", features: Sequence[str] = FEATURES, key: str | None = None, folds: int = 10, grid: Mapping[str, Sequence] | None = None, seed: int = 58):
    """Cross-validated over the grid by accuracy; folds come from a hash of the key."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    forest = RandomForestClassifier(labelCol=label, featuresCol="features", seed=seed)
    builder = ParamGridBuilder()
    for name, values in (grid or {"minInstancesPerNode": [3, 5, 10], "numTrees": [100, 300], "maxDepth": [3, 5, 15, 25], "featureSubsetStrategy": ["1", "2", "3", "4"]}).items():
        builder = builder.addGrid(getattr(forest, name), list(values))
    valid = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    kind = {"foldCol": "__fold"} if key else {}
    data = df.withColumn("__fold", F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(folds)).cast("int")) if key else df
    search = CrossValidator(estimator=Pipeline(stages=[assembler, forest]), estimatorParamMaps=builder.build(), evaluator=valid, numFolds=folds, seed=seed, **kind)
    return search.fit(data).bestModel


def score_forest(model, df: DataFrame, *, features: Sequence[str] = FEATURES) -> DataFrame:
    """y_pred, pred_0 and pred_1 of rows that have all features."""
    scored = model.transform(df.dropna(subset=list(features)))
    p = vector_to_array("probability")
    drop = [c for c in ("features", "rawPrediction", "probability", "prediction") if c in scored.columns]
    return scored.withColumns({"y_pred": F.col("prediction").cast("int"), "pred_0": p[0], "pred_1": p[1]}).drop(*drop)


#: A forest as a table: one row for each node; node 0 is its tree's root.  An inner node
#: leads to `lo` where the feature is at most the threshold, and else to `hi`; a leaf has no feature, and the class' shares.
NODES = "tree int, node int, feature string, threshold double, lo int, hi int, shares array<double>"
MOST_NODES = 1_000_000


def node_table(model, features: Sequence[str]) -> DataFrame:
    """The trees of a trained forest, or of the pipeline that ends in one, as NODES; splits on numbers only."""
    forest = getattr(model, "stages", [model])[-1]
    spark = SparkSession.active()
    path = new_folder(spark, "forest")
    forest.write().overwrite().save(path)
    data = spark.read.parquet(f"{path}/data")
    node = F.col("nodeData")
    name = F.get(F.array(*map(F.lit, features)), node["split"]["featureIndex"])
    inner = node["leftChild"] >= 0
    total = F.aggregate(node["impurityStats"], F.lit(0.0), lambda a, x: a + x)
    return data.select(
        F.col("treeID").cast("int").alias("tree"),
        node["id"].cast("int").alias("node"),
        F.when(inner, name).alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        F.when(inner, node["leftChild"]).cast("int").alias("lo"),
        F.when(inner, node["rightChild"]).cast("int").alias("hi"),
        F.when(~inner, F.transform(node["impurityStats"], lambda x: x / total)).alias("shares"),
    )


def score_nodes(df: DataFrame, nodes: DataFrame, key: Sequence[str], features: Sequence[str]) -> DataFrame:
    """key, y_pred, pred_0 and pred_1 by a node table, of rows that have all features; keys are different.

    Each row walks down all trees at once, a join with the table for each level.  A
    table of at most MOST_NODES rows is sent to all tasks, so the walk is no shuffle, and a row's
    trees are added up where they are; a larger one is joined by tree and node.
    """
    nodes = stage(nodes.select(*[c.split()[0] for c in NODES.split(", ")]), "nodes")
    small = nodes.limit(MOST_NODES + 1).count() <= MOST_NODES
    trees = sorted(r["tree"] for r in nodes.select("tree").distinct().collect())
    inner = nodes.where("feature IS NOT NULL").select("tree", F.col("node").alias("at"), "feature", "threshold", "lo", "hi")
    leaves = nodes.where("feature IS NULL").select("tree", F.col("node").alias("at"), "shares")
    sent = (lambda d: F.broadcast(d)) if small else (lambda d: d)
    held = F.map_from_arrays(F.array(*map(F.lit, features)), F.array(*[F.col(f"`{c}`").cast("double") for c in features]))
    walk = df.dropna(subset=list(features)).select(*key, held.alias("held"), F.explode(F.array(*map(F.lit, trees))).alias("tree"), F.lit(0).alias("at"))
    depth, frontier = 0, nodes.where("node = 0")
    children = nodes.select("tree", F.col("node").alias("child"), "lo", "hi")
    while (frontier := stage(frontier.where("lo IS NOT NULL").select("tree", F.explode(F.array("lo", "hi")).alias("child")).join(children, ["tree", "child"]), "level")).limit(1).count():
        depth += 1
    for _ in range(depth + 1):
        goes = F.when(F.col("feature").isNull(), F.col("at")).when(F.col("held")[F.col("feature")] <= F.col("threshold"), F.col("lo")).otherwise(F.col("hi"))
        walk = walk.join(sent(inner), ["tree", "at"], "left").select(*key, "held", "tree", goes.alias("at"))
    votes = walk.join(sent(leaves), ["tree", "at"]).groupBy(*key).agg(*[F.sum(F.col("shares")[k]).alias(f"v{k}") for k in (0, 1)])
    n = F.lit(float(len(trees)))
    return votes.select(*key, (F.col("v1") > F.col("v0")).cast("int").alias("y_pred"), (F.col("v0") / n).alias("pred_0"), (F.col("v1") / n).alias("pred_1"))


def confusion(scored: DataFrame, label: str = "label") -> DataFrame:
    return scored.groupBy(label, "y_pred").agg(F.count("*").alias("n"))

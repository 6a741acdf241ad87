"""Random-forest classification of comment class from the day's weather."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool
from operator import add

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import FOREST_DEPTH, FOREST_TREES, TRAIN_FRACTION
from ..session import scratch_path
from . import joins

FEATURES = ["city_index", "PRCP", "SNOW", "TMAX", "TMIN", "TAVG"]
MEASURES = ["PRCP", "SNOW", "TMAX", "TMIN", "TAVG"]
ROW_KEYS = ["station_id", "date", "comment_id"]

#: Station days and comments of a (city, date) that one task joins, about.
PIECE_STATIONS, PIECE_COMMENTS = 1024, 4096

#: Different rows of a partition of the rows that trees are grown on, about,
#: and trees grown side by side.
TREE_ROWS, TREES_AT_ONCE = 20000, 5


def _sides(weather: DataFrame, classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Complete station days, and comments with a class."""
    w = weather.select("station_id", "date", "city", *MEASURES).dropna()
    c = classified.select("date", F.col("subreddit").alias("city"), "comment_id", "sentiment")
    return w, c.where(F.col("sentiment").isNotNull())


def _joined(w: DataFrame, c: DataFrame) -> DataFrame:
    """Station days x comments of that city and day, in pieces of both, so
    that a (city, date) with many of them is not one task's."""
    def pieces(df: DataFrame, name: str, size: int) -> DataFrame:
        return df.groupBy("city", "date").agg(F.ceil(F.count(F.lit(1)) / size).alias(name))

    def each(n: str) -> F.Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    cut = joins.bounded(pieces(w, "__ns", PIECE_STATIONS).join(pieces(c, "__nc", PIECE_COMMENTS), ["city", "date"]))
    w = w.join(cut, ["city", "date"]).withColumn("__s", F.pmod(F.xxhash64("station_id"), "__ns")).withColumn("__c", each("__nc"))
    c = c.join(cut, ["city", "date"]).withColumn("__c", F.pmod(F.xxhash64("comment_id"), "__nc")).withColumn("__s", each("__ns"))
    return w.drop("__ns", "__nc").join(c.drop("__ns", "__nc"), ["city", "date", "__s", "__c"]).drop("__s", "__c")


def forest_rows(weather: DataFrame, classified: DataFrame) -> DataFrame:
    """Station days x comments of that city and day, all features present.

    The join is inner with a NULL filter (what a left join followed by
    dropping incomplete rows amounts to); the weather side is filtered
    first so only complete station days are shuffled.
    """
    return _joined(*_sides(weather, classified)).select(*ROW_KEYS, "city", *MEASURES, "sentiment")


def class_counts(weather: DataFrame, classified: DataFrame) -> DataFrame:
    """(city, sentiment, n): the rows of ``forest_rows`` counted, from the
    counts of both sides by city and day."""
    w, c = _sides(weather, classified)
    days = w.groupBy("city", "date").agg(F.count(F.lit(1)).alias("s"))
    said = c.groupBy("city", "date", "sentiment").agg(F.count(F.lit(1)).alias("c"))
    return days.join(said, ["city", "date"]).groupBy("city", "sentiment").agg(F.sum(F.col("s") * F.col("c")).alias("n"))


def split_counts(weather: DataFrame, classified: DataFrame, fraction: float = TRAIN_FRACTION) -> DataFrame:
    """(city, measures, sentiment, n_train, n_test): the rows of
    ``forest_rows`` that ``hash_split`` sends to either part, counted for
    each different set of features and class.

    Every row's bucket is taken, in the task that joins it; the rows are
    neither kept nor shuffled.  The parts of the key are made before the
    join.
    """
    w, c = _sides(weather, classified)
    w = w.withColumn("__day", F.concat_ws("|", "station_id", F.col("date").cast("string")))
    c = c.withColumn("comment_id", F.col("comment_id").cast("string"))
    rows = _joined(w, c).withColumn("__train", split_bucket(["__day", "comment_id"]) < _cut(fraction))
    return rows.groupBy("city", *MEASURES, "sentiment").agg(
        F.count_if("__train").alias("n_train"), F.count_if(~F.col("__train")).alias("n_test"))


def fit_index(df: DataFrame, columns: Sequence[str], handle_invalid: str = "error"):
    """One StringIndexer for all columns: most frequent value -> 0.0, ties
    by name; one pass over ``df``."""
    return StringIndexer(inputCols=list(columns), outputCols=[f"{c}_index" for c in columns],
                         handleInvalid=handle_invalid).fit(df)


def counted_index(df: DataFrame, columns: Sequence[str], count: str) -> PipelineModel:
    """What ``fit_index`` gives where each row of ``df`` stands for
    ``count`` rows: a StringIndexerModel for each column."""
    by = [df.groupBy(c).agg(F.sum(count).alias("__n")).orderBy(F.desc("__n"), c) for c in columns]
    return PipelineModel([StringIndexerModel.from_labels([r[0] for r in n.collect()], c, f"{c}_index", "error")
                          for c, n in zip(columns, by, strict=True)])


def index_labels(index: PipelineModel) -> list[list[str]]:
    """The values of each column in the order of their index."""
    return [list(stage.labelsArray[0]) for stage in index.stages]


def index_strings(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None,
                  handle_invalid: str = "error") -> DataFrame:
    """``<column>_index`` for each column.

    By default the indexer is fitted on ``df`` itself (every value is
    known).  ``fit_on`` fits on another frame, e.g. the training part,
    with ``handle_invalid='keep'`` giving unseen values their own index.
    """
    return fit_index(df if fit_on is None else fit_on, columns, handle_invalid).transform(df)


def assemble(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(df)


def split_bucket(keys: Sequence[str]) -> F.Column:
    """0..99 from the md5 of the row key: a split that does not depend on
    partitioning or on task retries."""
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return (F.conv(F.substring(F.md5(key), 1, 7), 16, 10).cast("bigint") % 100).cast("int")


def _cut(fraction: float) -> int:
    return int(round(fraction * 100))


def hash_split(df: DataFrame, keys: Sequence[str], fraction: float = TRAIN_FRACTION
               ) -> tuple[DataFrame, DataFrame]:
    b = df.withColumn("__bucket", split_bucket(keys))
    cut = _cut(fraction)
    return (b.where(F.col("__bucket") < cut).drop("__bucket"),
            b.where(F.col("__bucket") >= cut).drop("__bucket"))


def random_split(df: DataFrame, fraction: float = TRAIN_FRACTION, seed: int = 42
                 ) -> tuple[DataFrame, DataFrame]:
    """Seeded ``randomSplit``; reproducible only while the input partitioning
    stays the same, unlike ``hash_split``."""
    train, test = df.randomSplit([fraction, 1.0 - fraction], seed=seed)
    return train, test


def prepared_rows(rows: DataFrame) -> DataFrame:
    return assemble(index_strings(rows, ["sentiment", "city"]))


def forest_index(weather: DataFrame, classified: DataFrame) -> PipelineModel:
    """The indexer of ``forest_rows``, fitted on their counts."""
    return counted_index(class_counts(weather, classified), ["sentiment", "city"], "n")


def prepared(weather: DataFrame, classified: DataFrame, index=None) -> DataFrame:
    """Forest rows, indexed and assembled."""
    index = index or forest_index(weather, classified)
    return assemble(index.transform(forest_rows(weather, classified)))


def _drawn(trees: int, seed: int):
    """How often each tree's bag holds a row that stands for n equal rows.
    Each of those would be drawn a Poisson(1) number of times, so together
    they are drawn a Poisson(n) number of times."""
    def draw(key: pd.Series, n: pd.Series) -> pd.Series:
        made = zip(key.to_numpy(np.int64).view(np.uint64), n, strict=True)
        return pd.Series([np.random.Generator(np.random.Philox(key=[seed, k])).poisson(m, trees) for k, m in made], dtype=object)
    return F.pandas_udf(draw, "array<bigint>")


@dataclass(frozen=True)
class Forest:
    """Trees that vote with the shares of the classes in a row's leaves, as
    those of one ``RandomForestClassificationModel`` do."""

    trees: dict[int, RandomForestClassificationModel]

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the ``prediction``: the first class of the largest
        share.  The sums are rounded, as the order of their terms must not
        decide between equal classes."""
        out = rows
        for i, tree in self.trees.items():
            out = tree.setPredictionCol("").setRawPredictionCol("").setProbabilityCol(f"__votes_{i}").transform(out)
        votes = [vector_to_array(f"__votes_{i}") for i in self.trees]
        classes = max((tree.numClasses for tree in self.trees.values()), default=0)
        total = F.array(*[F.round(reduce(add, [F.get(v, F.lit(k)) for v in votes]), 9) for k in range(classes)])
        out = out.select(*rows.columns, total.cast("array<double>").alias("__total"))
        best = F.coalesce(F.array_position("__total", F.array_max("__total")) - 1, F.lit(0))
        return out.select(*rows.columns, best.cast("double").alias("prediction"))


def train_forest(train: DataFrame, seed: int = 42, trees: int = FOREST_TREES,
                 depth: int = FOREST_DEPTH, cities: int = 0, count: str | None = None) -> Forest:
    """A random forest on ``train``, whose rows stand for ``count`` rows
    each if that names a column.

    Rows with equal features and class are trained on once, with their
    number: each tree is grown on the different rows of its bag, weighted
    by how often the bag holds them, and so as it would be on the rows one
    by one.  A bag depends on the rows, not on their order or partitions.
    There is a bin for each of the ``cities``, as every value of a category
    needs one.  A tree whose bag is empty has no vote.
    """
    n = F.sum(count) if count else F.count(F.lit(1))
    kinds = joins.keep(train.groupBy("features", "sentiment_index").agg(n.alias("__n")).where(F.col("__n") > 0)
                       .withColumn("__key", F.xxhash64(vector_to_array("features"), "sentiment_index")))
    bags = kinds.repartition(1 + kinds.count() // TREE_ROWS, "__key").sortWithinPartitions("__key")
    bags = joins.keep(bags.withColumn("__bags", _drawn(trees, seed)("__key", "__n")))
    held = bags.agg(*[F.max(F.get("__bags", F.lit(i))) for i in range(trees)]).first()

    def grow(i: int):
        bag = bags.select("features", "sentiment_index", F.get("__bags", F.lit(i)).cast("double").alias("__n")).where("__n > 0")
        rf = RandomForestClassifier(labelCol="sentiment_index", featuresCol="features", weightCol="__n", numTrees=1,
                                    bootstrap=False, featureSubsetStrategy="sqrt" if trees > 1 else "all",
                                    maxDepth=depth, seed=seed + i, maxBins=max(32, cities))
        return i, rf.fit(bag)

    with ThreadPool(TREES_AT_ONCE) as pool:
        grown = pool.map(inheritable_thread_target(train.sparkSession)(grow), [i for i in range(trees) if held[i]], 1)
    return Forest(dict(grown))


def scored(model, rows: DataFrame, features: Sequence[str] = FEATURES, kinds: DataFrame | None = None) -> DataFrame:
    """``rows`` with the model's ``prediction``, made once for each
    different set of feature values and joined to the rows that have it.
    ``kinds`` may be a smaller frame with the same sets."""
    kinds = (rows if kinds is None else kinds).select(*features, "features").dropDuplicates(list(features))
    said = joins.bounded(model.transform(kinds).select(*features, "prediction"))
    return rows.join(said, list(features)).select(*rows.columns, "prediction")


def tree_rows(model: Forest) -> DataFrame:
    """The fitted trees as rows (tree, node, feature, cut, kinds, left,
    right, votes), read from the saved models.  A leaf has no feature; an
    inner node sends a value to the left where it is at most the first of
    ``cut`` or, with ``kinds`` >= 0, where it is one of ``cut``."""
    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, "forest")
    for i, tree in model.trees.items():
        tree.write().save(f"{path}/{i}")
    saved = [spark.read.parquet(f"{path}/{i}/data").withColumn("treeID", F.lit(i)) for i in model.trees]
    n = F.col("nodeData")
    total = F.aggregate(n["impurityStats"], F.lit(0.0), lambda a, x: a + x)
    inner = n["leftChild"] >= 0
    return reduce(DataFrame.unionByName, saved).select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), F.when(inner, n["split"]["featureIndex"]).alias("feature"),
        n["split"]["leftCategoriesOrThreshold"].alias("cut"), n["split"]["numCategories"].alias("kinds"),
        n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        F.transform(n["impurityStats"], lambda x: x / total).alias("votes"))


def replay(rows: DataFrame, trees: DataFrame, keys: Sequence[str], depth: int = FOREST_DEPTH) -> DataFrame:
    """(keys, prediction) of rows with a ``features`` vector, by walking
    all trees with joins: an independent application of ``tree_rows``.

    Rows with equal features walk together: what goes from node to node are
    the different vectors.  A forest has at most trees * 2^(depth + 1) nodes,
    whatever the rows; they are counted before they are broadcast.  The
    shares of a row's leaves are summed by class, and the first largest one
    is its class.
    """
    node = joins.bounded(trees.select(*[F.col(c).alias(f"t_{c}") for c in trees.columns]))
    roots = F.array_sort(F.collect_set("tree"))
    rows = rows.select(*keys, vector_to_array("features").alias("x"))
    walk = rows.select("x").distinct().withColumn("all", trees.agg(roots).scalar())
    walk = walk.select("x", F.explode("all").alias("tree")).withColumn("node", F.lit(0))
    here = (F.col("tree") == F.col("t_tree")) & (F.col("node") == F.col("t_node"))
    value = F.get("x", F.col("t_feature"))
    left = F.when(F.col("t_kinds") < 0, value <= F.get("t_cut", F.lit(0))).otherwise(F.array_contains("t_cut", value))
    step = F.when(F.col("t_feature").isNull(), F.col("node")).when(left, F.col("t_left")).otherwise(F.col("t_right"))
    for _ in range(depth):
        walk = walk.join(node, here).select("x", "tree", step.alias("node"))
    classes = range(trees.agg(F.max(F.size("votes"))).first()[0])
    shares = walk.join(node, here).groupBy(F.col("x").alias("s_x")).agg(
        *[F.sum(F.get("t_votes", F.lit(k))).alias(f"share_{k}") for k in classes])
    shares = joins.bounded(shares, joins.MAX_BROADCAST_BYTES // 4)  # a vector is wider than a number
    # Rounded, as the order of a sum's terms must not decide between equal classes.
    total = rows.join(shares, F.col("x").eqNullSafe(F.col("s_x"))).groupBy(*keys).agg(
        F.array(*[F.round(F.sum(f"share_{k}"), 9) for k in classes]).alias("total"))
    best = F.array_position("total", F.array_max("total")) - 1
    return total.select(*keys, best.cast("double").alias("prediction"))


def accuracy(predictions: DataFrame, count: str | None = None) -> DataFrame:
    """Rows, and the share of them that the prediction is right for; a row
    stands for ``count`` rows if that names a column."""
    n = F.col(count) if count else F.lit(1)
    right = F.when(F.col("prediction") == F.col("sentiment_index"), n).otherwise(0)
    total = F.coalesce(F.sum(n), F.lit(0))
    return predictions.agg(total.alias("n_test"), F.try_divide(F.sum(right).cast("double"), total.cast("double")).alias("accuracy"))

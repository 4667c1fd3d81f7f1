"""Scaling, clustering, projection and classification on symbol data."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, CountVectorizer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from glyphline.operators.profile import FEATURES


def standardize(df: DataFrame, cols: list[str] = FEATURES) -> DataFrame:
    """Centre and divide by the population deviation; a constant column becomes 0.

    ``df`` is a profile with one line per symbol, so its size is bounded by the
    vocabulary and the whole-table window is one small task; the texts behind it are
    read once, which separate statistics would not guarantee.
    """
    every = Window.partitionBy()

    def scaled(c: str):
        spread = F.nullif(F.stddev_pop(c).over(every), F.lit(0.0))
        return F.coalesce((F.col(c) - F.avg(c).over(every)) / spread, F.when(F.col(c).isNotNull(), F.lit(0.0)))

    return df.select("*", *[scaled(c).alias(f"z_{c}") for c in cols])


def _with_vector(df: DataFrame, cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """Complete rows with their vector, and the rows that lack a feature."""
    scaled = [f"z_{c}" for c in cols]
    complete = reduce(lambda a, c: a & F.col(c).isNotNull(), cols, F.lit(True))
    assembler = VectorAssembler(inputCols=scaled, outputCol="features")
    # the missing features are null in every statistic, so scaling before the split changes nothing
    return assembler.transform(standardize(df, cols).filter(complete)), df.filter(~complete)


def fit_clusters(profile: DataFrame, k: int = 5, seed: int = 42, cols: list[str] = FEATURES):
    """(rows with a cluster number, fitted model); a row that lacks a feature has a null cluster."""
    ready, rest = _with_vector(profile, cols)
    # to a fixed point: a profile has few rows, and a centre then is the mean of its members
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster", maxIter=200, tol=0.0).fit(ready)
    return model.transform(ready).unionByName(rest, allowMissingColumns=True), model


def cluster_symbols(profile: DataFrame, k: int = 5, seed: int = 42, cols: list[str] = FEATURES) -> DataFrame:
    """All symbols with a cluster number, which is null for symbols without any rating."""
    placed, _ = fit_clusters(profile, k, seed, cols)
    return placed.select(*profile.columns, "cluster")


def distance_to_centres(profile: DataFrame, k: int = 5, seed: int = 42, cols: list[str] = FEATURES) -> DataFrame:
    """symbol, cluster, and whether no centre is nearer than the cluster's own (null without a cluster)."""
    placed, model = fit_clusters(profile, k, seed, cols)
    point = vector_to_array("features")
    away = F.array(*[
        F.aggregate(
            F.zip_with(point, F.array(*map(F.lit, centre.tolist())), lambda x, c: (x - c) * (x - c)),
            F.lit(0.0), lambda a, d: a + d,
        )
        for centre in model.clusterCenters()
    ])
    own = F.get(away, F.col("cluster"))
    return placed.select("symbol", "cluster", (own <= F.array_min(away) + 1e-9).alias("nearest"))


def cluster_quality(profile: DataFrame, k: int = 5, seed: int = 42, cols: list[str] = FEATURES) -> DataFrame:
    """One line: ``rated`` rows and ``clusters`` among them; ``centre_gap``, the largest distance in one feature
    between a centre and the mean of its members (zero where the iteration has come to rest); and ``spread``,
    the squared distances to the centres as a share of those to the mean of all rows."""
    placed, model = fit_clusters(profile, k, seed, cols)
    rows = placed.filter(F.col("cluster").isNotNull()).withColumn("_v", vector_to_array("features"))
    centres = F.array(*[F.array(*map(F.lit, centre.tolist())) for centre in model.clusterCenters()])
    cells = rows.select("cluster", F.posexplode("_v").alias("j", "x"))
    cells = cells.withColumn("c", F.get(F.get(centres, F.col("cluster")), F.col("j")))
    members = cells.groupBy("cluster", "j").agg(
        F.abs(F.avg("x") - F.first("c")).alias("gap"), F.sum((F.col("x") - F.col("c")) ** 2).alias("own"),
        F.count(F.lit(1)).alias("n"), F.sum("x").alias("s"), F.sum(F.col("x") ** 2).alias("q"),
    )
    total = members.groupBy("j").agg(
        F.max("gap").alias("gap"), F.sum("own").alias("own"), F.sum("n").alias("n"),
        (F.sum("q") - F.sum("s") ** 2 / F.sum("n")).alias("all"), F.count(F.lit(1)).alias("clusters"),
    )
    return total.agg(
        F.max("n").alias("rated"), F.max("clusters").alias("clusters"), F.max("gap").alias("centre_gap"),
        (F.sum("own") / F.sum("all")).alias("spread"),
    )


def pca2(profile: DataFrame, cols: list[str] = FEATURES, components: int = 2) -> DataFrame:
    """All symbols with coordinates on the first components, null for symbols without any
    rating. The sign of a component is fixed: its largest loading is positive."""
    ready, rest = _with_vector(profile, cols)
    axes = principal_axes(ready, components)
    point = vector_to_array("features")
    coordinates = [
        F.aggregate(
            F.zip_with(point, F.array(*map(F.lit, axis)), lambda x, w: x * w), F.lit(0.0), lambda a, v: a + v
        ).alias(f"pca{i + 1}")
        for i, axis in enumerate(axes)
    ]
    placed = ready.select(*profile.columns, *coordinates)
    return placed.unionByName(rest, allowMissingColumns=True)


def principal_axes(ready: DataFrame, components: int) -> list[list[float]]:
    """The first principal axes of the vectors, each with its largest loading positive."""
    loadings = PCA(k=components, inputCol="features", outputCol="projected").fit(ready).pc.toArray()
    return [(column if column[abs(column).argmax()] > 0 else -column).tolist() for column in loadings.T]


def axis_residuals(profile: DataFrame, cols: list[str] = FEATURES, components: int = 2) -> DataFrame:
    """How well the axes solve the eigenvalue problem: for each pair of axes i <= j, ``product``
    (one for an axis with itself, zero otherwise) and ``residual``, the largest entry of
    C v - (v C v) v for axis i (zero). C is the covariance of the scaled features, aggregated
    from the rows."""
    ready, _ = _with_vector(profile, cols)
    axes = principal_axes(ready, components)
    scaled = [f"z_{c}" for c in cols]
    pairs = [F.covar_pop(a, b).alias(f"{i}_{j}") for i, a in enumerate(scaled) for j, b in enumerate(scaled)]
    cells = F.array(*[F.array(*[F.col(f"{i}_{j}") for j in range(len(scaled))]) for i in range(len(scaled))])
    literal = lambda axis: F.array(*map(F.lit, axis))
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    listed = F.array(*[
        F.struct(
            F.lit(i + 1).alias("axis"), F.lit(j + 1).alias("other"), literal(axes[i]).alias("v"), literal(axes[j]).alias("w")
        )
        for i in range(components) for j in range(i, components)
    ])
    covariance = ready.agg(*pairs).select(cells.alias("c"))
    spread = covariance.select("c", F.explode(listed).alias("p")).select("c", "p.*")
    image = spread.withColumn("image", F.transform("c", lambda line: dot(line, F.col("v"))))
    scaled_axis = image.withColumn("value", dot(F.col("image"), F.col("v")))
    off = F.zip_with("image", "v", lambda a, b: F.abs(a - F.col("value") * b))
    return scaled_axis.select("axis", "other", dot(F.col("v"), F.col("w")).alias("product"), F.array_max(off).alias("residual"))


def _vocabulary_size(df: DataFrame) -> int:
    """Distinct symbols of a frame: the vectoriser needs the number, and cuts what exceeds it."""
    return max(1, df.select(F.explode("symbols")).distinct().count())


def symbol_vectors(df: DataFrame):
    """Fitted count vectoriser over the symbol arrays, with every symbol that occurs."""
    return CountVectorizer(inputCol="symbols", outputCol="features", vocabSize=_vocabulary_size(df)).fit(df)


def fit_symbol_classifier(
    df: DataFrame, label: str = "emotion", trees: int = 100, seed: int = 42, depth: int = 5, memory_mb: int = 512
) -> PipelineModel:
    """Random forest from symbol counts to a label; rows without a label are left out of the
    fit. ``depth`` is the depth of a tree, at most 30; ``memory_mb`` bounds the statistics of the
    nodes that are split in one pass over the rows, so more of it means fewer passes."""
    known = df.select("symbols", label).filter(F.col(label).isNotNull())
    # every tree passes over the rows again and again: over all cores, not over the few
    # partitions that adaptive execution leaves of a small aggregate
    known = known.repartition(df.sparkSession.sparkContext.defaultParallelism)
    return Pipeline(
        stages=[
            CountVectorizer(inputCol="symbols", outputCol="features", vocabSize=_vocabulary_size(known)),
            StringIndexer(inputCol=label, outputCol="label_index", handleInvalid="skip"),
            RandomForestClassifier(
                featuresCol="features", labelCol="label_index", numTrees=trees, seed=seed, maxDepth=depth,
                maxMemoryInMB=memory_mb,
            ),
        ]
    ).fit(known)


def held_out_accuracy(
    df: DataFrame, test: Column, label: str = "emotion", trees: int = 100, seed: int = 42, depth: int = 5
) -> DataFrame:
    """One line on the labelled rows where ``test`` holds, by a forest fitted on the others: ``rows``, ``right``, and
    ``majority``, how many have the label that is most frequent among the rows of the fit."""
    known = df.filter(F.col(label).isNotNull())
    fit, held = known.filter(~test), known.filter(test)
    model = fit_symbol_classifier(fit, label, trees, seed, depth)
    usual = fit.groupBy(label).agg(F.count(F.lit(1)).alias("_n")).agg(F.max_by(label, F.struct("_n", label))).scalar()
    return predicted_labels(model, held).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("predicted") == F.col(label)).alias("right"),
        F.count_if(F.col(label) == usual).alias("majority"),
    )


def predicted_labels(model: PipelineModel, df: DataFrame, out: str = "predicted") -> DataFrame:
    """Predict for rows with or without a known label."""
    vectors, indexer, forest = model.stages
    names = F.array(*[F.lit(name) for name in indexer.labels])
    scored = forest.transform(vectors.transform(df))
    return scored.withColumn(out, F.get(names, F.col("prediction").cast("int"))).drop(
        "features", "rawPrediction", "probability", "prediction"
    )

"""Splits, resampling, features and metrics for labelled sequences."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType


BUCKETS = 4096


def _ranked(rows, label, key):
    """Adds _n, the place of each row among those of its label by hash order, and _all, their number.

    Two levels: counts of hash ranges first, then a window inside each small range, so that no
    label is one task's.
    """
    r = rows.withColumn("_h", F.md5(F.col(key).cast("string"))).withColumn("_b", F.conv(F.substring("_h", 1, 3), 16, 10).cast("int"))
    counts = r.groupBy(label, "_b").agg(F.count("*").alias("_size"))
    before = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0))).withColumn("_all", F.sum("_size").over(Window.partitionBy(label)))
    # 4,096 ranges a label
    r = r.join(counts.drop("_size"), [label, "_b"])
    inside = F.row_number().over(Window.partitionBy(label, "_b").orderBy("_h", key))
    return r.withColumn("_n", F.col("_before") + inside).drop("_h", "_b", "_before")


def stratified_split(rows, label, key, share=0.2):
    """Adds test: exactly floor(share * n) rows of each label, by hash order."""
    return _ranked(rows, label, key).withColumn("test", F.col("_n") <= F.floor(share * F.col("_all"))).drop("_n", "_all")


def _class_sizes(rows, label):
    return F.broadcast(rows.agg(F.count_if(F.col(label) == 1).alias("_1"), F.count_if(F.col(label) == 0).alias("_0")))


def balance(rows, label, key, fraction=0.5):
    """Under-samples the larger class so that label 1 is about the fraction of rows."""
    r = _ranked(rows, label, key).drop("_all").join(_class_sizes(rows, label))
    limit = F.when(F.col(label) == 1, F.floor(F.col("_0") * fraction / (1 - fraction))).otherwise(F.floor(F.col("_1") * (1 - fraction) / fraction))
    return r.where(F.col("_n") <= limit).drop("_n", "_1", "_0")


def oversample(rows, label, key, fraction=0.5):
    """Repeats rows of the smaller class, in hash order and round again, until label 1 is about the fraction of rows; adds copy."""
    r = _ranked(rows, label, key).join(_class_sizes(rows, label))
    want = F.when(F.col(label) == 1, F.floor(F.col("_0") * fraction / (1 - fraction))).otherwise(F.floor(F.col("_1") * (1 - fraction) / fraction))
    want = F.greatest(want, F.col("_all"))
    copies = (F.floor(want / F.col("_all")) + F.when(F.col("_n") <= want % F.col("_all"), 1).otherwise(0)).cast("int")
    return r.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("_n", "_all", "_1", "_0")


def curve_points(scored, group, label, score):
    """One row a distinct score, from the highest: cut, fpr, tpr (recall) and precision at that cut."""
    g = scored.groupBy(group, score).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("q"))
    down, every = Window.partitionBy(group).orderBy(F.desc(score)), Window.partitionBy(group)
    tp, fp = F.sum("p").over(down), F.sum("q").over(down)
    return g.select(group, F.col(score).alias("cut"), F.try_divide(fp, F.sum("q").over(every)).alias("fpr"), F.try_divide(tp, F.sum("p").over(every)).alias("tpr"), F.try_divide(tp, tp + fp).alias("precision"))


def best_by_auroc(scored, group, label, score):
    """The group of the highest area under the curve, the first by name among equals."""
    return auroc(scored, group, label, score).orderBy(F.desc_nulls_last("auroc"), group).limit(1)


def auroc(scored, group, label, score):
    """Area under the ROC curve from rank sums, ties at average rank. One pass per distinct score."""
    g = scored.groupBy(group, score).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("q"))
    below = F.coalesce(F.sum("q").over(Window.partitionBy(group).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    g = g.withColumn("w", F.col("p") * (below + F.col("q") / 2))
    return g.groupBy(group).agg(F.try_divide(F.sum("w"), F.sum("p") * F.sum("q")).alias("auroc"))


def average_precision(scored, group, label, score):
    """Mean of precision over recall steps, equal scores taken together."""
    g = scored.groupBy(group, score).agg(F.count_if(F.col(label) == 1).alias("p"), F.count("*").alias("n"))
    w = Window.partitionBy(group).orderBy(F.desc(score))
    g = g.withColumn("w", F.col("p") * F.sum("p").over(w) / F.sum("n").over(w))
    return g.groupBy(group).agg(F.try_divide(F.sum("w"), F.sum("p")).alias("ap"))


def confusion(scored, group, label, score, cut):
    """Counts, accuracy, precision, recall, F1 and MCC at a cut."""
    hit, yes = F.col(label) == 1, F.col(score) >= cut
    g = scored.groupBy(group).agg(F.count_if(hit & yes).alias("tp"), F.count_if(~hit & yes).alias("fp"), F.count_if(hit & ~yes).alias("fn"), F.count_if(~hit & ~yes).alias("tn"))
    d = {c: F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn")}
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    return g.withColumns({
        "accuracy": zero(F.try_divide(d["tp"] + d["tn"], d["tp"] + d["fp"] + d["fn"] + d["tn"])),
        "precision": zero(F.try_divide(d["tp"], d["tp"] + d["fp"])),
        "recall": zero(F.try_divide(d["tp"], d["tp"] + d["fn"])),
        "f1": zero(F.try_divide(2 * d["tp"], 2 * d["tp"] + d["fp"] + d["fn"])),
        "mcc": zero(F.try_divide(d["tp"] * d["tn"] - d["fp"] * d["fn"], F.sqrt((d["tp"] + d["fp"]) * (d["tp"] + d["fn"]) * (d["tn"] + d["fp"]) * (d["tn"] + d["fn"])))),
    })


def one_hot(rows, seq, length, letters):
    """A vector of length * len(letters) zeros and ones; unknown letters are all zeros."""
    return rows.withColumn("features", F.flatten(F.transform(F.sequence(F.lit(1), F.lit(length)), lambda i: F.transform(F.split(F.lit(letters), ""), lambda a: F.when(F.substr(F.col(seq), i, F.lit(1)) == a, 1.0).otherwise(0.0)))))


def balanced_weights(rows, label):
    """Adds weight: n / (2 * rows of the label)."""
    sizes = rows.groupBy(label).agg(F.count("*").alias("_size"))
    total = rows.agg(F.count("*").alias("_total"))
    return rows.join(F.broadcast(sizes), label).join(F.broadcast(total)).withColumn("weight", F.col("_total") / (2 * F.col("_size"))).drop("_size", "_total")


def scale(rows, features="features"):
    """Adds scaled: features over their population standard deviation, not centred; constant features stay."""
    size = F.posexplode(features).alias("i", "x")
    d = rows.select(size).groupBy("i").agg(F.stddev_pop("x").alias("sd"))
    every = d.agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "sd"))), lambda s: F.when(s["sd"] > 0, s["sd"]).otherwise(1.0)).alias("_sd"))
    return rows.join(F.broadcast(every)).withColumn("scaled", F.zip_with(features, "_sd", lambda x, sd: x / sd)).drop("_sd")


def fourier_features(rows, kernel="rbf", gamma=0.05, width=256, seed=42, features="features"):
    """Adds mapped: random features whose products come near a kernel, so that a linear model stands for a kernel machine.

    rbf is exp(-gamma * squared distance), laplace exp(-gamma * sum of differences).
    """
    if kernel not in ("rbf", "laplace"):
        raise ValueError(f"no such kernel: {kernel}")

    def mapped(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column(features).flatten().to_numpy().reshape(b.num_rows, -1)
            rng = np.random.default_rng(seed)
            size = (x.shape[1], width)
            w = rng.normal(scale=np.sqrt(2 * gamma), size=size) if kernel == "rbf" else gamma * rng.standard_cauchy(size)
            z = np.sqrt(2 / width) * np.cos(x @ w + rng.uniform(0, 2 * np.pi, width))
            yield b.append_column("mapped", pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1) * width, pa.int32()), pa.array(z.ravel())))

    return rows.mapInArrow(mapped, StructType([*rows.schema.fields, StructField("mapped", ArrayType(DoubleType()))]))


class OneLabel:
    """Stands for a model where all rows to learn from have one label, or where there are none (label None)."""

    def __init__(self, label, margin):
        self.predicted = label
        self.score = None if label is None else float(label or -margin)


def fit_model(train, kind, label="label", features="features"):
    """A fitted MLlib model of balanced classes: logistic regression, forest, linear SVM or perceptron.

    A kernel machine is an svm on fourier_features; the perceptron has sigmoid units in place of rectified ones and takes
    steps over all rows until its loss stands still: in 20 steps it falls by less than 1e-6 of the first loss, or it has no slope.
    MLlib's fits fail or give single-class vectors unless both labels are there; other rows give a OneLabel.
    """
    from pyspark.ml.classification import LinearSVC, LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    if kind not in ("logistic", "forest", "svm", "perceptron"):
        raise ValueError(f"no such model: {kind}")
    train = train.where(F.col(label).isNotNull())
    least, most, n = train.agg(F.min(label), F.max(label), F.count("*")).first()
    if least == most:
        return OneLabel(least, margin=kind == "svm")
    rows = balanced_weights(train, label).withColumn("vector", array_to_vector(features))
    shared = {"featuresCol": "vector", "labelCol": label}
    if kind == "perceptron":
        width = rows.select(F.size(features)).first()[0]
        # blocks of 128 rows weigh the same, and so does each partition's last block, however short: few rows go to few partitions
        if n < 1024 * rows.sparkSession.sparkContext.defaultParallelism:
            rows = rows.repartition(max(1, n // 1024))
        # no limit of steps: the loss never rises and is never below 0, so the tolerance ends them
        made = MultilayerPerceptronClassifier(layers=[width, 256, 64, 2], maxIter=2**31 - 1, tol=1e-6, seed=42, **shared)
    else:
        made = {
            "logistic": lambda: LogisticRegression(maxIter=500, weightCol="weight", **shared),
            "forest": lambda: RandomForestClassifier(numTrees=300, maxDepth=15, minInstancesPerNode=5, weightCol="weight", seed=42, **shared),
            "svm": lambda: LinearSVC(weightCol="weight", **shared),
        }[kind]()
    return made.fit(rows)


def predict(model, rows, features="features"):
    """Adds score (the chance of label 1, or the margin of an SVM) and predicted.

    A OneLabel gives its label with chance 1 or margin 1 to every row, nulls if it learned from no row.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array

    if isinstance(model, OneLabel):
        return rows.withColumn("score", F.lit(model.score).cast("double")).withColumn("predicted", F.lit(model.predicted).cast("int"))
    out = model.transform(rows.withColumn("vector", array_to_vector(features)))
    raw = "probability" if "probability" in out.columns else "rawPrediction"
    return out.withColumn("score", vector_to_array(raw)[1]).withColumn("predicted", F.col("prediction").cast("int")).select(*rows.columns, "score", "predicted")

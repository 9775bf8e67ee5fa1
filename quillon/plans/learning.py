"""Queries of features, resampling, curves and fitted models."""

from pyspark.sql import functions as F

from quillon.functions import seq as S
from quillon.operators import ml
from quillon.plans import derived as D
from quillon.plans.catalog import LABELS, SCORED, _labels, _scored
from quillon.plans.registry import query
from quillon.session import materialize

_ROWS = f"{LABELS}, r AS (SELECT concat(peptide, aa_seq) AS id, aa_seq, CAST(specificity = 1 AS int) AS label FROM labels_ WHERE specificity IN (0, 1))"


def _rows(spark, sf_dir):
    r = _labels(spark, sf_dir).where("specificity IN (0, 1)")
    return r.select(F.concat("peptide", "aa_seq").alias("id"), "aa_seq", (F.col("specificity") == 1).cast("int").alias("label"))


def _features(spark, sf_dir):
    return ml.one_hot(_rows(spark, sf_dir), "aa_seq", 11, S.AMINO_LETTERS)


@query(f"WITH {_ROWS} SELECT id, {' || '.join(f'''list_aggregate([CASE WHEN substr(aa_seq, {i}, 1) = x THEN '1' ELSE '0' END FOR x IN string_split('{S.AMINO_LETTERS}', '')], 'string_agg', '')''' for i in range(1, 12))} AS bits FROM r")
def one_hot_features(spark, sf_dir):
    return _features(spark, sf_dir).select("id", F.array_join(F.transform("features", lambda x: x.cast("int").cast("string")), "").alias("bits"))


@query(f"""WITH s AS ({SCORED}), e AS (SELECT id, 0 AS i, CAST(score AS double) AS x FROM s UNION ALL SELECT id, 1, CAST(label AS double) FROM s UNION ALL SELECT id, 2, 7.0 FROM s), d AS (SELECT i, stddev_pop(x) AS sd FROM e GROUP BY 1)
SELECT id, CAST(i AS int) AS i, round(x / CASE WHEN sd > 0 THEN sd ELSE 1 END, 6) AS x FROM e JOIN d USING (i)""")
def scaled_features(spark, sf_dir):
    rows = _scored(spark, sf_dir).select("id", F.array(F.col("score").cast("double"), F.col("label").cast("double"), F.lit(7.0)).alias("features"))
    return ml.scale(rows).select("id", F.posexplode("scaled").alias("i", "x")).select("id", "i", F.round("x", 6).alias("x"))


_CLASSES = f"s AS ({SCORED}), n AS (SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(id AS varchar)), id) AS n, count(*) OVER (PARTITION BY label) AS m, count(*) FILTER (label = 1) OVER () AS a, count(*) FILTER (label = 0) OVER () AS b FROM s)"


@query(f"WITH {_CLASSES}, w AS (SELECT *, greatest(CASE WHEN label = 1 THEN b ELSE a END, m) AS want FROM n) SELECT id, label, CAST(unnest(range(1, want // m + CASE WHEN n <= want % m THEN 1 ELSE 0 END + 1)) AS int) AS copy FROM w")
def resample_oversample(spark, sf_dir):
    return ml.oversample(_scored(spark, sf_dir).select("id", "label"), "label", "id")


@query(f"""WITH s AS ({SCORED}), g AS (SELECT grp, score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS q FROM s GROUP BY 1, 2)
SELECT grp, score AS cut, CAST(sum(q) OVER o / sum(q) OVER e AS double) AS fpr, CAST(sum(p) OVER o / sum(p) OVER e AS double) AS tpr, CAST(sum(p) OVER o / (sum(p) OVER o + sum(q) OVER o) AS double) AS precision FROM g WINDOW o AS (PARTITION BY grp ORDER BY score DESC), e AS (PARTITION BY grp)""")
def curve_points(spark, sf_dir):
    return ml.curve_points(_scored(spark, sf_dir), "grp", "label", "score")


@query(f"""WITH s AS ({SCORED}), r AS (SELECT grp, label, rank() OVER (PARTITION BY grp ORDER BY score) + (count(*) OVER (PARTITION BY grp, score) - 1) / 2 AS r FROM s),
g AS (SELECT grp, sum(r) FILTER (label = 1) AS s, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS q FROM r GROUP BY 1) SELECT grp, round((s - p * (p + 1) / 2) / (p * q), 9) AS auroc FROM g ORDER BY auroc DESC, grp LIMIT 1""")
def best_by_auroc(spark, sf_dir):
    return ml.best_by_auroc(_scored(spark, sf_dir), "grp", "label", "score").withColumn("auroc", F.round("auroc", 9))


def _fitted(name, kind, kernel=None):
    def run(spark, sf_dir):
        rows, inputs = _features(spark, sf_dir), "features"
        if kernel:
            rows, inputs = ml.fourier_features(rows, kernel), "mapped"
        # a fit reads its rows many times; the labels behind them are worked out once
        split = materialize(ml.stratified_split(rows, "label", "id"), f"split-{name}")
        model = ml.fit_model(split.where("NOT test"), kind, features=inputs)
        return ml.predict(model, split.where("test").select("id", "label", inputs), inputs).select("id", "label", F.round("score", 6).alias("score"), "predicted")

    run.__name__ = f"model_{name}"
    return query()(run)


# fitted models have no SQL form; the tests ask for a held-out accuracy
for _name, _kind, _kernel in (("logistic", "logistic", None), ("forest", "forest", None), ("svm", "svm", None), ("svm_rbf", "svm", "rbf"), ("svm_laplace", "svm", "laplace"), ("perceptron", "perceptron", None)):
    _fitted(_name, _kind, _kernel)

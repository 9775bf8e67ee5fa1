"""Quality trimming and read funnels."""

from pyspark.sql import functions as F

from quillon.functions import seq as S


def quality_trim(reads, quality=20, least=30, mode="tail"):
    """Adds kept_length, trimmed and kept. Right end only.

    tail drops trailing bases below the quality; sum keeps the prefix with the greatest sum of
    10^(-Q/10) - 10^(-q/10), the longest among equals. Reads shorter than least are not kept.
    """
    q = S.phred("qual")
    if mode == "tail":
        n = F.coalesce(F.array_max(F.filter(F.transform(q, lambda x, i: F.when(x >= quality, i + 1).otherwise(0)), lambda x: x > 0)), F.lit(0))
    else:
        # gains first: a base of just the quality gains 0, so it ties and the longer prefix stays
        gains = F.transform(q, lambda x: F.lit(10.0 ** (-quality / 10.0)) - F.pow(F.lit(10.0), -x / 10.0))
        start = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("best"), F.lit(0).alias("n"), F.lit(0).alias("i"))

        def step(a, g):
            now = a["s"] + g
            longer = F.when(now >= a["best"], a["i"] + 1).otherwise(a["n"])
            return F.struct(now.alias("s"), F.greatest(a["best"], now).alias("best"), longer.alias("n"), (a["i"] + 1).alias("i"))

        fold = F.aggregate(gains, start, step)
        n = fold["n"]
    r = reads.withColumn("kept_length", n.cast("long"))
    return r.withColumn("trimmed", F.col("kept_length") < F.length("qual")).withColumn("kept", F.col("kept_length") >= least)


def trim_summary(trimmed, keys):
    return trimmed.groupBy(*keys).agg(
        F.count("*").alias("reads_in"),
        F.sum(F.length("qual")).cast("long").alias("bases_in"),
        F.count_if("kept").alias("reads_out"),
        F.coalesce(F.sum(F.when(F.col("kept"), F.col("kept_length"))), F.lit(0)).alias("bases_out"),
        F.count_if("trimmed").alias("reads_qtrimmed"),
    )


def long_metrics(wide, keys, step):
    """One row a metric: keys, step, metric, value."""
    names = [c for c in wide.columns if c not in keys]
    return wide.select(*keys, *[F.col(c).cast("double").alias(c) for c in names]).unpivot(keys, names, "metric", "value").withColumn("step", F.lit(step))


def metric_table(long, keys):
    return long.groupBy(*keys).pivot("metric").agg(F.sum("value")).na.fill(0)


def reason_metrics(rows, keys, reason, step, total, passed, lost):
    """keys, step, metric, value: rows in all, rows without a reason, and rows lost by groups of reasons.

    lost: metric name to the reasons folded into it.
    """
    g = rows.groupBy(*keys).agg(
        F.count("*").alias(total),
        F.count_if(F.col(reason).isNull()).alias(passed),
        *[F.count_if(F.col(reason).isin(*names)).alias(metric) for metric, names in lost.items()],
    )
    return long_metrics(g, keys, step)


def pass_table(long, keys, total="total_reads", passed="pass", prefix="fail_"):
    """metric_table with pass_rate and total_fail, the sum over whatever fail columns there are."""
    wide = metric_table(long, keys)
    fails = [c for c in wide.columns if c.startswith(prefix)]
    rate = F.try_divide(passed, total) if {passed, total} <= set(wide.columns) else F.lit(0.0)
    every = F.lit(0.0)
    for c in fails:
        every = every + F.col(c)
    return wide.withColumn("pass_rate", rate).withColumn("total_fail", every)


def qc_ratios(sums):
    """Adds shares and averages of summed counts; null where the divisor is 0."""
    share = lambda a, b, k=100: F.try_divide(k * F.col(a), F.col(b).cast("double"))
    return sums.withColumns({
        "retention_reads_pct": share("reads_out", "reads_in"),
        "retention_bases_pct": share("bases_out", "bases_in"),
        "avg_read_len_in": share("bases_in", "reads_in", 1),
        "avg_read_len_out": share("bases_out", "reads_out", 1),
        "qtrim_share_of_removed_reads_pct": share("reads_qtrimmed", "reads_removed"),
    })


def merge_pairs(pairs, least=10, most_mismatches=0):
    """Adds merged: r1 and the reverse complement of r2 joined at their longest overlap, null without one.

    An overlap has `least` bases or more and at most so many mismatches; r1's bases are kept.
    """
    r = pairs.withColumn("_b", S.reverse_complement("r2"))
    most = F.least(F.length("r1"), F.length("_b"))

    def fits(n):
        left, right = F.substr("r1", F.length("r1") - n + 1, n), F.substr("_b", F.lit(1), n)
        return S.hamming(left, right) <= most_mismatches if most_mismatches else left == right

    n = F.array_max(F.filter(F.when(most >= least, F.sequence(F.lit(least), most)).otherwise(F.array().cast("array<int>")), fits))
    return r.withColumn("overlap", n).withColumn("merged", F.concat("r1", F.substr("_b", F.col("overlap") + 1, F.length("_b")))).drop("_b")


def repair(left, right, key="read_id"):
    """The reads that both files have, side by side, and those that one of them has, with their side."""
    both = left.select(key, F.col("seq").alias("r1")).join(right.select(key, F.col("seq").alias("r2")), key, "full_outer")
    side = F.when(F.col("r2").isNull(), "only_1").when(F.col("r1").isNull(), "only_2").otherwise("pair")
    return both.withColumn("side", side)

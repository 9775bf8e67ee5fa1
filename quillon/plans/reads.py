"""Queries over derived reads: barcodes, consensus, rescue, trimming and anchors."""

from pyspark.sql import functions as F

from quillon.functions import search, seq as S
from quillon.operators import trim, umi
from quillon.plans import derived as D
from quillon.plans.catalog import PATTERNS, _translate_sql
from quillon.plans.registry import query
from quillon.session import materialize

ANCHOR, SIZE = D.ANCHOR, len(D.ANCHOR)
MIN_READS = 2
#: The first anchor that starts where the spacer lets it; others only tell that there is one.
EXTRACTED = f"""
reads AS ({D.READS}),
at_ AS (SELECT *, list_min(list_filter(range(13, 17), lambda p: substr(seq, p, {SIZE}) = '{ANCHOR}')) AS hit FROM reads),
ex AS (SELECT *, CASE WHEN length(seq) < {15 + SIZE} THEN 'too_short' WHEN hit IS NULL AND NOT contains(seq, '{ANCHOR}') THEN 'no_anchor' WHEN hit IS NULL THEN 'anchor_wrong_pos' WHEN length(seq) < hit + {SIZE} THEN 'empty_insert' END AS drop_reason FROM at_),
ok AS (SELECT k, read_no, tmpl, substr(seq, hit - 12, 12) AS umi, substr(seq, hit + {SIZE}) AS insert, substr(qual, hit + {SIZE}) AS insert_qual FROM ex WHERE drop_reason IS NULL)"""
CLASSES = f"""{EXTRACTED}, c AS (SELECT umi, count(*) AS n_reads FROM ok GROUP BY 1),
k AS (SELECT *, CASE WHEN n_reads >= 3 THEN 'consensus' WHEN n_reads = 1 THEN 'singleton' ELSE 'other' END AS kind FROM c)"""
#: Only barcodes with enough reads are called.
COLUMNS = f"""{EXTRACTED}, c AS (SELECT umi, count(*) AS n_reads FROM ok GROUP BY 1 HAVING count(*) >= {MIN_READS}),
b AS (SELECT umi, n_reads, p - 1 AS pos, substr(insert, p, 1) AS base, least(greatest(pow(10.0::double, -(ascii(substr(insert_qual, p, 1)) - 33) / 10.0::double), 1e-12), 1 - 1e-12) AS pe
    FROM (SELECT umi, n_reads, insert, insert_qual, unnest(range(1, length(insert) + 1)) AS p FROM ok JOIN c USING (umi))),
v AS (SELECT umi, n_reads, pos, {', '.join(f"coalesce(round(sum(ln(1 - pe) - ln(pe / 3)) FILTER (base = '{x}'), 6), 0) AS {x}" for x in 'ACGT')} FROM b GROUP BY 1, 2, 3),
s AS (SELECT *, list_sort([A, C, G, T], 'DESC') AS r FROM v),
d AS (SELECT *, round(r[1] - r[2], 6) AS log_delta FROM s),
cols AS (SELECT umi, n_reads, pos, CASE WHEN log_delta < 2 THEN 'N' WHEN A = r[1] THEN 'A' WHEN C = r[1] THEN 'C' WHEN G = r[1] THEN 'G' ELSE 'T' END AS call, log_delta FROM d)"""
CONSENSUS = f"{COLUMNS}, g AS (SELECT umi, n_reads, string_agg(call, '' ORDER BY pos) AS cons_seq, list(log_delta ORDER BY log_delta) AS d FROM cols GROUP BY 1, 2)"
#: Rescue: variants behind an anchor in the inserts of barcodes with one read.
RESCUE_ANCHOR, RESCUE_SIZE = "GA", 12
SINGLES = f"""{EXTRACTED}, one AS (SELECT umi, any_value(insert) AS insert, any_value(insert_qual) AS q FROM ok GROUP BY 1 HAVING count(*) = 1),
p AS (SELECT concat(umi, '|n=1') AS read_id, insert, q, instr(insert, '{RESCUE_ANCHOR}') AS a FROM one),
var AS (SELECT split_part(read_id, '|n=', 1) AS umi, read_id, insert, q, CASE WHEN a = 0 THEN 'no_anchor' WHEN length(insert) < a + {1 + RESCUE_SIZE} THEN 'too_short_after_anchor' END AS reason, substr(insert, a + 2, {RESCUE_SIZE}) AS variant FROM p),
kept AS (SELECT variant, count(DISTINCT umi) AS n_umis FROM var WHERE reason IS NULL GROUP BY 1 HAVING count(DISTINCT umi) >= 2)"""


def _extracted(spark, sf_dir):
    return umi.extract(D.reads(spark, sf_dir), ANCHOR)


def _umis(spark, sf_dir):
    # one shuffle of the reads by barcode; everything grouped below by barcode needs no other
    return _extracted(spark, sf_dir).where("drop_reason IS NULL").select("k", "read_no", "tmpl", "umi", "insert", "insert_qual").repartition("umi")


def _called(spark, sf_dir):
    return umi.posterior_columns(umi.of_size(_umis(spark, sf_dir), MIN_READS))


def _variants(spark, sf_dir):
    r = umi.singletons(_umis(spark, sf_dir)).withColumn("umi", umi.umi_of("read_id"))
    return r.withColumn("reason", umi.anchored_reason("seq", RESCUE_ANCHOR, RESCUE_SIZE)).withColumn("variant", umi.anchored_variant("seq", RESCUE_ANCHOR, RESCUE_SIZE))


@query(f"WITH {EXTRACTED} SELECT coalesce(drop_reason, 'ok') AS reason, count(*) AS n FROM ex GROUP BY 1")
def umi_extract_reasons(spark, sf_dir):
    return _extracted(spark, sf_dir).groupBy(F.coalesce("drop_reason", F.lit("ok")).alias("reason")).agg(F.count("*").alias("n"))


@query()
def umi_extract_fuzzy(spark, sf_dir):
    """Reasons with one edit in the anchor; held against brute force in the tests."""
    r = umi.extract(D.reads(spark, sf_dir), ANCHOR, edits=1)
    return r.groupBy(F.coalesce("drop_reason", F.lit("ok")).alias("reason")).agg(F.count("*").alias("n"), F.count_distinct("umi").alias("n_umis"))


@query(f"WITH {COLUMNS} SELECT umi, n_reads, CAST(pos AS int) AS pos, call, log_delta FROM cols")
def umi_consensus_calls(spark, sf_dir):
    return _called(spark, sf_dir)


@query(f"""WITH {CONSENSUS} SELECT umi, n_reads, cons_seq, len(d) AS cons_len, CAST(length(cons_seq) - length(replace(cons_seq, 'N', '')) AS bigint) AS n_n,
    round(d[1], 3) AS min_log_delta, round((d[(len(d) + 1) // 2] + d[len(d) // 2 + 1]) / 2, 3) AS median_log_delta, round(d[(len(d) - 1) // 10 + 1], 3) AS p10_log_delta FROM g""")
def umi_consensus_qc(spark, sf_dir):
    return umi.consensus(_called(spark, sf_dir))


@query(f"WITH {CONSENSUS} SELECT concat(umi, '|n=', n_reads) AS read_id, cons_seq AS seq, repeat('I', length(cons_seq)) AS qual FROM g")
def consensus_records(spark, sf_dir):
    return umi.consensus_records(umi.consensus(_called(spark, sf_dir)))


@query(f"WITH {CONSENSUS} SELECT CAST(length(cons_seq) AS bigint) AS cons_len, count(*) AS n, count(*) FILTER (contains(cons_seq, 'N')) AS n_with_n FROM g GROUP BY 1")
def consensus_length_hist(spark, sf_dir):
    return umi.consensus(_called(spark, sf_dir)).groupBy("cons_len").agg(F.count("*").alias("n"), F.count_if(F.col("n_n") > 0).alias("n_with_n"))


@query(f"WITH {CONSENSUS} SELECT count(*) AS n, avg(CAST(contains(cons_seq, 'N') AS int)) AS share_with_n FROM g")
def consensus_n_share(spark, sf_dir):
    return umi.consensus(_called(spark, sf_dir)).agg(F.count("*").alias("n"), F.avg((F.col("n_n") > 0).cast("int")).alias("share_with_n"))


@query(f"WITH {CLASSES} SELECT kind, count(*) AS n_umis, CAST(sum(n_reads) AS bigint) AS n_reads FROM k GROUP BY 1")
def umi_classes(spark, sf_dir):
    return umi.classes(_umis(spark, sf_dir), 3).groupBy("kind").agg(F.count("*").alias("n_umis"), F.sum("n_reads").alias("n_reads"))


@query(f"WITH {CLASSES} SELECT n_reads, count(*) AS n_umis FROM k GROUP BY 1")
def reads_per_umi_hist(spark, sf_dir):
    return umi.classes(_umis(spark, sf_dir)).groupBy("n_reads").agg(F.count("*").alias("n_umis"))


@query(f"WITH {SINGLES} SELECT read_id, umi, reason, CASE WHEN reason IS NULL THEN variant END AS variant FROM var")
def singleton_variants(spark, sf_dir):
    return _variants(spark, sf_dir).select("read_id", "umi", "reason", "variant")


@query(f"WITH {SINGLES} SELECT variant, n_umis FROM kept")
def singleton_rescue(spark, sf_dir):
    return umi.rescue(_variants(spark, sf_dir).where("reason IS NULL"))


@query(f"WITH {SINGLES} SELECT read_id, insert AS seq, q AS qual, variant FROM var WHERE reason IS NULL AND variant IN (SELECT variant FROM kept)")
def rescued_reads(spark, sf_dir):
    return umi.rescued_reads(_variants(spark, sf_dir).where("reason IS NULL")).select("read_id", "seq", "qual", "variant")


@query(f"""WITH {SINGLES}, c2 AS (SELECT umi, count(*) AS n_reads FROM ok GROUP BY 1 HAVING count(*) >= {MIN_READS})
SELECT 'consensus' AS source, count(*) AS n FROM c2 UNION ALL SELECT 'singleton', count(*) FROM var WHERE reason IS NULL AND variant IN (SELECT variant FROM kept)""")
def extraction_inputs(spark, sf_dir):
    rescued = umi.rescued_reads(_variants(spark, sf_dir).where("reason IS NULL")).select("read_id", "seq", "qual")
    both = umi.extraction_inputs(umi.consensus_records(umi.consensus(_called(spark, sf_dir))), rescued)
    return both.groupBy("source").agg(F.count("*").alias("n"))


@query(f"""WITH {EXTRACTED}, b AS (SELECT umi, read_no, p - 1 AS pos, substr(insert, p, 1) AS base FROM (SELECT umi, read_no, insert, unnest(range(1, length(insert) + 1)) AS p FROM ok)),
v AS (SELECT umi, pos, base, count(*) AS n, min(read_no) AS seen FROM b GROUP BY 1, 2, 3)
SELECT umi, CAST(pos AS int) AS pos, base AS call FROM v QUALIFY row_number() OVER (PARTITION BY umi, pos ORDER BY n DESC, seen) = 1""")
def majority_consensus(spark, sf_dir):
    return umi.majority(_umis(spark, sf_dir))


SOFT = f"""{EXTRACTED}, c AS (SELECT umi, insert, count(*) AS n FROM ok GROUP BY 1, 2),
w AS (SELECT umi, insert, n, row_number() OVER o AS rank, sum(n) OVER (PARTITION BY umi) AS total, coalesce(sum(n) OVER (PARTITION BY umi ORDER BY n DESC, insert ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM c WINDOW o AS (PARTITION BY umi ORDER BY n DESC, insert))"""
GRID = ((1, 1), (2, 1), (3, 1), (1, 2), (2, 2))


@query(f"WITH {SOFT} SELECT umi, insert, n, rank FROM w WHERE before / total < 0.9 AND rank <= 3")
def soft_consensus(spark, sf_dir):
    return umi.soft(_umis(spark, sf_dir))


@query(f"""WITH {SOFT}, p AS (SELECT * FROM (VALUES {', '.join(map(str, GRID))}) t(top_k, least)), f AS (SELECT p.*, w.* FROM w, p WHERE n >= least AND total >= {MIN_READS}),
r AS (SELECT * EXCLUDE (rank), row_number() OVER (PARTITION BY top_k, least, umi ORDER BY n DESC, insert) AS rank FROM f)
SELECT CAST(top_k AS int) AS top_k, CAST(least AS int) AS least, count(*) AS n_rows, CAST(sum(n) AS bigint) AS n_reads FROM r WHERE rank <= top_k GROUP BY 1, 2""")
def soft_consensus_grid(spark, sf_dir):
    return umi.soft_grid(_umis(spark, sf_dir), GRID, MIN_READS).groupBy("top_k", "least").agg(F.count("*").alias("n_rows"), F.sum("n").alias("n_reads"))


@query(f"""WITH {CONSENSUS} SELECT umi, round(coalesce(avg(CASE WHEN length(insert) = length(cons_seq) THEN CAST(hamming(insert, cons_seq) AS double) END), 0), 9) AS divergence FROM ok JOIN g USING (umi) GROUP BY 1""")
def hamming_divergence(spark, sf_dir):
    u = _umis(spark, sf_dir)
    called = umi.consensus(umi.posterior_columns(umi.of_size(u, MIN_READS)))
    return umi.divergence(u, called).withColumn("divergence", F.round("divergence", 9))


@query(f"WITH {EXTRACTED}, t AS (SELECT umi, {_translate_sql('insert')} AS aa FROM ok) SELECT aa, count(*) AS reads, count(DISTINCT umi) AS umi_count, array_to_string(list_sort(list(DISTINCT umi)), ',') AS umis FROM t GROUP BY 1")
def translation_rollup(spark, sf_dir):
    t = _umis(spark, sf_dir).select("umi", S.translate_region("insert").alias("aa"))
    return t.groupBy("aa").agg(F.count("*").alias("reads"), F.count_distinct("umi").alias("umi_count"), F.array_join(F.sort_array(F.collect_set("umi")), ",").alias("umis"))


@query(f"""WITH reads AS ({D.READS}), l AS (SELECT k, read_no, seq, instr(substr(seq, 13), '{ANCHOR}') AS a FROM reads)
SELECT k, read_no, CASE WHEN a > 0 THEN substr(seq, 1, 12) END AS umi, CASE WHEN a > 0 THEN substr(seq, 12 + a) END AS insert FROM l""")
def umi_extract_legacy(spark, sf_dir):
    return umi.extract_legacy(D.reads(spark, sf_dir), ANCHOR).select("k", "read_no", "umi", "insert")


# --- funnels of all steps ------------------------------------------------------------------------

FUNNEL = f"""reads AS ({D.READS}), t AS (SELECT k % 8 AS sample, qual, length(regexp_replace(qual, '[!-4]+$', '')) AS kept_length FROM reads),
fun AS (SELECT sample, count(*) AS reads_in, CAST(sum(length(qual)) AS bigint) AS bases_in, count(*) FILTER (kept_length >= 50) AS reads_out, CAST(coalesce(sum(kept_length) FILTER (kept_length >= 50), 0) AS bigint) AS bases_out,
    count(*) FILTER (kept_length < length(qual)) AS reads_qtrimmed FROM t GROUP BY 1)"""


def _funnel(spark, sf_dir):
    return trim.trim_summary(trim.quality_trim(D.reads(spark, sf_dir).withColumn("sample", F.col("k") % 8), 20, 50), ["sample"])


@query(f"WITH reads AS ({D.READS}) SELECT k, read_no, CAST(length(regexp_replace(qual, '[!-4]+$', '')) AS bigint) AS kept_length FROM reads")
def quality_trim(spark, sf_dir):
    return trim.quality_trim(D.reads(spark, sf_dir), 20).select("k", "read_no", "kept_length")


@query(f"""WITH reads AS ({D.READS}), q AS (SELECT row_number() OVER () AS rid, k, read_no, [ascii(x) - 33 FOR x IN string_split(qual, '')] AS q FROM reads),
g AS (SELECT rid, k, read_no, list_transform(q, lambda x: 0.01::double - pow(10.0::double, -x / 10.0::double)) AS g FROM q),
s AS (SELECT rid, k, read_no, i, sum(g[i]) OVER (PARTITION BY rid ORDER BY i ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT rid, k, read_no, g, unnest(range(1, len(g) + 1)) AS i FROM g)),
m AS (SELECT rid, greatest(max(s), 0) AS best FROM s GROUP BY 1)
SELECT k, read_no, CAST(coalesce(max(i) FILTER (s >= best - 1e-12), 0) AS bigint) AS kept_length FROM s JOIN m USING (rid) GROUP BY rid, k, read_no""")
def quality_trim_sum(spark, sf_dir):
    return trim.quality_trim(D.reads(spark, sf_dir), 20, mode="sum").select("k", "read_no", "kept_length")


@query(f"WITH {FUNNEL} SELECT * FROM fun")
def read_funnel_pivot(spark, sf_dir):
    long = trim.long_metrics(_funnel(spark, sf_dir), ["sample"], "trim")
    wide = trim.metric_table(long, ["sample"])
    return wide.select("sample", *[F.col(c).cast("long").alias(c) for c in wide.columns if c != "sample"])


@query(f"WITH {FUNNEL} SELECT sample, metric, CAST(value AS double) AS value, 'trim' AS step FROM (UNPIVOT fun ON reads_in, bases_in, reads_out, bases_out, reads_qtrimmed INTO NAME metric VALUE value)")
def read_funnel_long(spark, sf_dir):
    return trim.long_metrics(_funnel(spark, sf_dir), ["sample"], "trim")


@query(f"WITH {FUNNEL} SELECT sample, reads_out / reads_in AS pass_rate, bases_out / bases_in AS base_rate FROM fun")
def pass_rate_report(spark, sf_dir):
    return _funnel(spark, sf_dir).select("sample", F.try_divide("reads_out", "reads_in").alias("pass_rate"), F.try_divide("bases_out", "bases_in").alias("base_rate"))


@query(f"""WITH {FUNNEL}, x AS (SELECT CAST(sample % 3 AS bigint) AS lane, *, reads_in - reads_out AS reads_removed, bases_in - bases_out AS bases_removed FROM fun),
a AS (SELECT lane, count(*) AS n, count(DISTINCT sample) AS samples, {', '.join(f'CAST(sum({c}) AS bigint) AS {c}' for c in ('reads_in', 'reads_out', 'reads_removed', 'reads_qtrimmed', 'bases_in', 'bases_out', 'bases_removed'))} FROM x GROUP BY 1)
SELECT *, 100 * reads_out / reads_in AS retention_reads_pct, 100 * bases_out / bases_in AS retention_bases_pct, bases_in / reads_in AS avg_read_len_in, bases_out / nullif(reads_out, 0) AS avg_read_len_out,
    100 * reads_qtrimmed / nullif(reads_removed, 0) AS qtrim_share_of_removed_reads_pct FROM a""")
def sample_qc_summary(spark, sf_dir):
    f = _funnel(spark, sf_dir).withColumns({"lane": F.col("sample") % 3, "reads_removed": F.col("reads_in") - F.col("reads_out"), "bases_removed": F.col("bases_in") - F.col("bases_out")})
    sums = ("reads_in", "reads_out", "reads_removed", "reads_qtrimmed", "bases_in", "bases_out", "bases_removed")
    return trim.qc_ratios(f.groupBy("lane").agg(F.count("*").alias("n"), F.count_distinct("sample").alias("samples"), *[F.sum(c).alias(c) for c in sums]))


UMI_LOST = {f"reads_lost_{r}": (r,) for r in ("too_short", "no_anchor", "anchor_wrong_pos", "empty_insert")}
_lost_sql = lambda reason, lost: ", ".join(f"CAST(count(*) FILTER ({reason} IN ({', '.join(repr(r) for r in rs)})) AS double) AS {m}" for m, rs in lost.items())


@query(f"""WITH {EXTRACTED}, f AS (SELECT k % 8 AS sample, CAST(count(*) AS double) AS reads_in, CAST(count(*) FILTER (drop_reason IS NULL) AS double) AS reads_kept, {_lost_sql('drop_reason', UMI_LOST)} FROM ex GROUP BY 1)
SELECT sample, metric, value, '02_umi' AS step FROM (UNPIVOT f ON COLUMNS(* EXCLUDE sample) INTO NAME metric VALUE value)""")
def funnel_umi(spark, sf_dir):
    return trim.reason_metrics(_extracted(spark, sf_dir).withColumn("sample", F.col("k") % 8), ["sample"], "drop_reason", "02_umi", "reads_in", "reads_kept", UMI_LOST)


RESCUE_LOST = {"reads_lost_no_anchor": ("no_anchor",), "reads_lost_too_short": ("too_short_after_anchor",)}


@query(f"""WITH {SINGLES}, f AS (SELECT substr(umi, 1, 1) AS sample, CAST(count(*) AS double) AS reads_in, CAST(count(*) FILTER (reason IS NULL) AS double) AS reads_extracted, {_lost_sql('reason', RESCUE_LOST)} FROM var GROUP BY 1)
SELECT sample, metric, value, '02a_rescue' AS step FROM (UNPIVOT f ON COLUMNS(* EXCLUDE sample) INTO NAME metric VALUE value)""")
def funnel_rescue(spark, sf_dir):
    return trim.reason_metrics(_variants(spark, sf_dir).withColumn("sample", F.substring("umi", 1, 1)), ["sample"], "reason", "02a_rescue", "reads_in", "reads_extracted", RESCUE_LOST)


@query(f"""WITH {FUNNEL}, {EXTRACTED.replace(f"reads AS ({D.READS}),", "").strip()}, a AS (SELECT sample, 'trim' AS step, metric, CAST(value AS double) AS value FROM (UNPIVOT fun ON reads_in, reads_out INTO NAME metric VALUE value)),
f AS (SELECT k % 8 AS sample, CAST(count(*) AS double) AS reads_in, CAST(count(*) FILTER (drop_reason IS NULL) AS double) AS reads_kept FROM ex GROUP BY 1)
SELECT * FROM a UNION ALL SELECT sample, '02_umi', metric, value FROM (UNPIVOT f ON reads_in, reads_kept INTO NAME metric VALUE value)""")
def metrics_of_steps(spark, sf_dir):
    one = trim.long_metrics(_funnel(spark, sf_dir).select("sample", "reads_in", "reads_out"), ["sample"], "trim")
    two = trim.reason_metrics(_extracted(spark, sf_dir).withColumn("sample", F.col("k") % 8), ["sample"], "drop_reason", "02_umi", "reads_in", "reads_kept", {})
    return one.unionByName(two).select("sample", "step", "metric", "value")


# --- anchors ---------------------------------------------------------------------------------------


@query()
def fuzzy_anchor(spark, sf_dir):
    """Anchor with one edit, insertions and deletions too; held against brute force in the tests."""
    r = D.reads(spark, sf_dir).select("k", "read_no", search.edit_anchor("seq", ANCHOR, 1, 12, 15).alias("hit"))
    return r.select("k", "read_no", F.col("hit.start").alias("start"), F.col("hit.end").alias("end"), F.col("hit.any").alias("any"))


_HITS = f"reads AS ({D.READS}), h AS (SELECT k, read_no, seq, list_filter(range(1, CAST(length(seq) - {SIZE - 2} AS bigint)), lambda i: hamming(substr(seq, i, {SIZE}), '{ANCHOR}') <= 1) AS h FROM reads)"


@query(f"WITH {_HITS} SELECT k, read_no, CAST(coalesce(list_max(h), 0) AS int) AS hit FROM h")
def substitution_anchor_rightmost(spark, sf_dir):
    return D.reads(spark, sf_dir).select("k", "read_no", search.last_substitution_hit("seq", ANCHOR, 1).alias("hit"))


@query(f"WITH {_HITS} SELECT k, read_no, CAST(coalesce(list_min(h), 0) AS int) AS hit FROM h")
def substitution_anchor_first(spark, sf_dir):
    return D.reads(spark, sf_dir).select("k", "read_no", search.substitution_hit("seq", ANCHOR, 1).alias("hit"))

"""Queries over the driver's tables, each beside the SQL that gives the same rows."""

from pyspark.sql import functions as F

from quillon.functions import protein as P, search, seq as S
from quillon.operators import label, library, ml, stats, trim
from quillon.plans import derived as D
from quillon.plans.registry import FOUND, query
from quillon.sources import fastq

ANCHOR = D.ANCHOR
PATTERNS = ("NNN", "NNN", "NNB", "VNN", "NNK", "NNN", "DNN", "NNN", "NNN", "NHN", "NNN")
WILDTYPE = "GCCAGCAGCCCGAATATGGCGGATGAACAGTAC"
DNA = f"{D.HEX}, 'ACGTACGTACGTACGT'"


def _every():
    """All queries: importing a module of them registers them."""
    from quillon.plans import analysis, learning, reads, samples  # noqa: F401

    return FOUND


def queries():
    return {name: f for name, (f, _) in _every().items()}


def oracle_sql():
    return {name: sql for name, (_, sql) in _every().items() if sql}


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- selection: counts, ratios, labels ---------------------------------------------------------

WIDE = f"""
sel AS ({D.SELECTION}),
per AS (SELECT peptide, aa_seq, 0 AS lib, count(*) FILTER (condition = 'neg') AS neg, count(*) FILTER (condition = 'pos3x') AS pos3x, count(*) FILTER (condition = 'pos1x') AS pos1x
    FROM sel WHERE condition IN ('neg', 'pos3x', 'pos1x') GROUP BY 1, 2),
lib AS (SELECT aa_seq, count(*) AS lib FROM sel WHERE condition = 'lib' GROUP BY 1),
outer_ AS (SELECT coalesce(p.peptide, l.peptide) AS peptide, coalesce(p.aa_seq, l.aa_seq) AS aa_seq, coalesce(l.lib, 0) AS count_lib, coalesce(neg, 0) AS count_neg, coalesce(pos3x, 0) AS count_pos3x, coalesce(pos1x, 0) AS count_pos1x
    FROM per p FULL OUTER JOIN (SELECT n.peptide, lib.* FROM (SELECT DISTINCT peptide FROM per) n, lib) l ON p.peptide = l.peptide AND p.aa_seq = l.aa_seq),
wide AS (SELECT *, count_lib / sum(count_lib) OVER w AS freq_lib, count_neg / sum(count_neg) OVER w AS freq_neg, count_pos3x / sum(count_pos3x) OVER w AS freq_pos3x, count_pos1x / sum(count_pos1x) OVER w AS freq_pos1x
    FROM outer_ WINDOW w AS (PARTITION BY peptide)),
rat AS (SELECT *, (freq_pos3x + 1e-9) / (freq_neg + 1e-9) AS enrich_pos3x_vs_neg, (freq_pos1x + 1e-9) / (freq_neg + 1e-9) AS enrich_pos1x_vs_neg,
    (freq_pos3x + 1e-9) / (freq_lib + 1e-9) AS enrich_pos3x_vs_lib, (freq_pos1x + 1e-9) / (freq_lib + 1e-9) AS enrich_pos1x_vs_lib, (freq_neg + 1e-9) / (freq_lib + 1e-9) AS deplete_neg_lib FROM wide)"""
_flag = lambda c, name: f"CASE WHEN {c} >= 2 THEN 'Enriched' WHEN {c} <= 0.5 THEN 'Depleted' ELSE 'NoChange' END AS {name}"
_both = lambda a, b, name: f"CASE WHEN {a} = 'Enriched' OR {b} = 'Enriched' THEN 'Enriched' WHEN {a} = 'Depleted' AND {b} = 'Depleted' THEN 'Depleted' ELSE 'NoChange' END AS {name}"
_spec = "CASE WHEN (pos_vs_neg_status = 'Enriched' OR pos_vs_lib_status = 'Enriched') AND neg_vs_lib_status <> 'Enriched' THEN 1 WHEN pos_vs_neg_status <> 'Enriched' AND pos_vs_lib_status <> 'Enriched' AND neg_vs_lib_status = 'Enriched' THEN 0 ELSE 2 END AS specificity"
LABELS = f"""{WIDE},
st AS (SELECT *, {_flag('enrich_pos3x_vs_neg', 'pos3x_vs_neg_status')}, {_flag('enrich_pos3x_vs_lib', 'pos3x_vs_lib_status')}, {_flag('enrich_pos1x_vs_neg', 'pos1x_vs_neg_status')},
    {_flag('enrich_pos1x_vs_lib', 'pos1x_vs_lib_status')}, {_flag('deplete_neg_lib', 'neg_vs_lib_status')} FROM rat),
st2 AS (SELECT *, {_both('pos3x_vs_neg_status', 'pos1x_vs_neg_status', 'pos_vs_neg_status')}, {_both('pos3x_vs_lib_status', 'pos1x_vs_lib_status', 'pos_vs_lib_status')} FROM st),
labels_ AS (SELECT *, {_spec} FROM st2)"""
_COLS = "aa_seq, peptide, count_lib, freq_lib, count_neg, freq_neg, count_pos3x, freq_pos3x, count_pos1x, freq_pos1x"
_RATIOS = "enrich_pos3x_vs_neg, enrich_pos1x_vs_neg, enrich_pos3x_vs_lib, enrich_pos1x_vs_lib, deplete_neg_lib"


def _wide(spark, sf_dir):
    return label.wide_counts(D.selection(spark, sf_dir))


def _labels(spark, sf_dir):
    return label.label(_wide(spark, sf_dir))


@query(f"WITH {LABELS} SELECT {_COLS}, {_RATIOS}, pos3x_vs_neg_status, pos3x_vs_lib_status, pos1x_vs_neg_status, pos1x_vs_lib_status, pos_vs_neg_status, pos_vs_lib_status, neg_vs_lib_status, specificity FROM labels_")
def specificity_labels(spark, sf_dir):
    return _labels(spark, sf_dir)


@query(f"WITH {WIDE} SELECT {_COLS} FROM wide")
def variant_counts_freq(spark, sf_dir):
    return _wide(spark, sf_dir)


@query(f"WITH {WIDE} SELECT peptide, aa_seq, {_RATIOS} FROM rat")
def enrichment_ratios(spark, sf_dir):
    return _labels(spark, sf_dir).select("peptide", "aa_seq", *_RATIOS.split(", "))


@query(f"""WITH {WIDE}, a AS (SELECT peptide, aa_seq, {_flag('enrich_pos3x_vs_neg', 'pos_vs_neg_status')}, {_flag('enrich_pos3x_vs_lib', 'pos_vs_lib_status')}, {_flag('deplete_neg_lib', 'neg_vs_lib_status')} FROM rat)
SELECT *, {_spec} FROM a""")
def specificity_labels_single_pos(spark, sf_dir):
    s = D.selection(spark, sf_dir).replace("pos3x", "pos", "condition")
    # peptides are those with any arm, the second positive arm included
    w = label.wide_counts(s, ("lib", "neg", "pos", "pos1x")).drop("count_pos1x", "freq_pos1x")
    return label.label(w, ("pos",)).select("peptide", "aa_seq", "pos_vs_neg_status", "pos_vs_lib_status", "neg_vs_lib_status", "specificity")


@query(f"WITH {LABELS} SELECT peptide, count(*) AS n_variants, count(*) FILTER (specificity = 1) AS n_spec_1, count(*) FILTER (specificity = 0) AS n_spec_0, count(*) FILTER (specificity = 2) AS n_spec_2 FROM labels_ GROUP BY 1")
def label_summary(spark, sf_dir):
    return label.label_summary(_labels(spark, sf_dir))


@query(f"WITH sel AS ({D.SELECTION}) SELECT peptide, count(DISTINCT condition) FILTER (condition IN ('neg', 'pos3x', 'pos1x')) = 3 AS complete FROM sel GROUP BY 1")
def required_condition_gate(spark, sf_dir):
    return label.complete_peptides(D.selection(spark, sf_dir))


_SAMPLE = "concat('clib', p_brand, CASE p_size % 6 WHEN 0 THEN 'originallib' WHEN 1 THEN '_2xnegative' WHEN 2 THEN '3xpositive' WHEN 3 THEN '31xpositive' ELSE '' END)"


@query(f"""SELECT p_partkey, CASE WHEN p_size % 6 < 4 THEN p_brand END AS peptide, CASE p_size % 6 WHEN 0 THEN 'lib' WHEN 1 THEN 'neg' WHEN 2 THEN 'pos3x' WHEN 3 THEN 'pos1x' END AS condition FROM part""")
def condition_token_parse(spark, sf_dir):
    peptide, condition = label.parse_condition(F.col("s"))
    return _table(spark, sf_dir, "part").selectExpr("p_partkey", f"{_SAMPLE} AS s").select("p_partkey", peptide.alias("peptide"), condition.alias("condition"))


#: Several lines a name, with other sequences: the last line counts.
_LINES = "SELECT p_brand AS name, translate(substr(md5(concat(p_brand, cast(p_partkey % 3 AS string))), 1, 9), '0123456789abcdef', 'ACDEFGHIKLMNPQRS') AS sequence, p_partkey AS line FROM part WHERE p_brand NOT LIKE '%1'"
_MAP = f"SELECT name, sequence FROM ({_LINES}) l QUALIFY row_number() OVER (PARTITION BY name ORDER BY line DESC) = 1"


def _mapping(spark, sf_dir):
    return D.view(spark, sf_dir, _LINES, "part")


@query(f"WITH {LABELS}, m AS ({_MAP}) SELECT aa_seq AS tcr, sequence AS peptide, specificity AS label FROM labels_ LEFT JOIN m ON peptide = name WHERE specificity IN (0, 1)")
def ml_export(spark, sf_dir):
    return label.ml_rows(_labels(spark, sf_dir), _mapping(spark, sf_dir), "line")


@query(f"WITH m AS ({_MAP}) SELECT p_partkey, sequence FROM part LEFT JOIN m ON p_brand = name")
def peptide_lookup(spark, sf_dir):
    m = label.last_by_name(_mapping(spark, sf_dir), "line")
    p = _table(spark, sf_dir, "part")
    return p.join(m, p.p_brand == m.name, "left").select("p_partkey", "sequence")


@query(f"WITH m AS ({_MAP}) SELECT p_brand, count(*) AS n FROM part WHERE p_brand NOT IN (SELECT name FROM m) GROUP BY 1")
def unmapped_peptides(spark, sf_dir):
    m = label.last_by_name(_mapping(spark, sf_dir), "line")
    p = _table(spark, sf_dir, "part")
    return p.join(m, p.p_brand == m.name, "left_anti").groupBy("p_brand").agg(F.count("*").alias("n"))


# --- library: regions and designs --------------------------------------------------------------

_codon_sql = lambda s, i: f"CASE WHEN regexp_full_match(substr({s}, {3 * i + 1}, 3), '[ACGT]{{3}}') THEN substr('{S.AMINO}', 16 * (instr('TCAG', substr({s}, {3 * i + 1}, 1)) - 1) + 4 * (instr('TCAG', substr({s}, {3 * i + 2}, 1)) - 1) + instr('TCAG', substr({s}, {3 * i + 3}, 1)), 1) ELSE 'X' END"
_translate_sql = lambda s, n=11: "concat(" + ", ".join(_codon_sql(s, i) for i in range(n)) + ")"

REGION = f"""
r AS ({D.REGIONS}),
f AS (SELECT k, seq, CASE WHEN instr(seq, '{ANCHOR}') = 0 THEN 0 ELSE length(seq) - instr(reverse(seq), '{ANCHOR[::-1]}') - 6 END AS hit FROM r),
g AS (SELECT k, hit, substr(seq, hit + 8, 33) AS raw FROM f),
h AS (SELECT k, CASE WHEN hit = 0 THEN 'anchor_not_found' WHEN length(raw) < 33 THEN 'region_too_short' WHEN contains(raw, 'N') THEN 'contains_N' END AS fail_reason, raw FROM g),
reg AS (SELECT k, fail_reason, CASE WHEN fail_reason IS NULL THEN reverse(translate(raw, 'ACGTMRWSYKVHDBN', 'TGCAKYWSRMBDHVN')) END AS region FROM h)"""
_pat = lambda i, p: f"regexp_full_match(substr(region, {3 * i + 1}, 3), '{S.degenerate_regex(p)}')"
COMB = f"""{REGION}, ok AS (SELECT * FROM reg WHERE fail_reason IS NULL),
val AS (SELECT k, CASE {' '.join(f"WHEN {_codon_sql('region', i)} = '*' THEN 'stop_codon' WHEN NOT {_pat(i, p)} THEN 'degenerate_mismatch'" for i, p in enumerate(PATTERNS))} END AS reason,
    CAST(CASE {' '.join(f"WHEN {_codon_sql('region', i)} = '*' OR NOT {_pat(i, p)} THEN {i + 1}" for i, p in enumerate(PATTERNS))} END AS bigint) AS fail_pos FROM ok)"""
_chg = lambda i: f"substr(region, {3 * i + 1}, 3) <> '{WILDTYPE[3 * i : 3 * i + 3]}'"
#: A wild type with a few changes, so that all outcomes of the codon-change design occur.
NNK_ROWS = f"""SELECT p_partkey AS k, concat({', '.join(f"CASE WHEN substr(md5(concat('m', cast(p_partkey AS string))), {i + 1}, 1) < '3' THEN translate(substr(md5(concat('c{i}', cast(p_partkey AS string))), 1, 3), {DNA}) ELSE '{WILDTYPE[3 * i : 3 * i + 3]}' END" for i in range(11))}) AS region FROM part"""
NNK = f"""nr AS ({NNK_ROWS}),
val AS (SELECT k, {' + '.join(f"CAST({_chg(i)} AS int)" for i in range(11))} AS n, concat_ws(',', {', '.join(f"CASE WHEN {_chg(i)} THEN '{i + 1}' END" for i in range(11))}) AS mutated,
    CASE {' '.join(f"WHEN {_chg(i)} AND {_codon_sql('region', i)} = '*' THEN 'stop_codon' WHEN {_chg(i)} AND NOT {_pat(i, 'NNK')} THEN 'mutation_not_NNK'" for i in range(11))} END AS bad FROM nr),
val2 AS (SELECT k, mutated, n, CASE WHEN n > 3 THEN 'too_many_mutations' ELSE bad END AS reason FROM val)"""


def _regions(spark, sf_dir):
    return library.extract_region(D.regions(spark, sf_dir), ANCHOR)


def _nnk(spark, sf_dir):
    return library.validate_nnk(D.view(spark, sf_dir, NNK_ROWS, "part"), WILDTYPE)


@query(f"WITH {REGION} SELECT k, fail_reason, region FROM reg")
def region_extract_rightmost(spark, sf_dir):
    return _regions(spark, sf_dir).select("k", "fail_reason", "region")


@query(f"WITH {REGION} SELECT k, region, {_translate_sql('region')} AS aa FROM reg WHERE fail_reason IS NULL")
def revcomp_translate(spark, sf_dir):
    return _regions(spark, sf_dir).where("fail_reason IS NULL").select("k", "region", "aa")


@query(f"WITH {COMB} SELECT k, reason, fail_pos FROM val")
def combinatorial_validate(spark, sf_dir):
    return library.validate_combinatorial(_regions(spark, sf_dir).where("fail_reason IS NULL"), PATTERNS).select("k", "reason", "fail_pos")


@query(f"WITH {NNK} SELECT k, mutated, reason FROM val2")
def nnk_validate(spark, sf_dir):
    return _nnk(spark, sf_dir).select("k", F.array_join("mutated", ",").alias("mutated"), "reason")


@query(f"WITH {COMB} SELECT coalesce(fail_reason, reason, 'pass') AS reason, count(*) AS n FROM reg LEFT JOIN val USING (k) GROUP BY 1")
def fail_reason_counts(spark, sf_dir):
    r = _regions(spark, sf_dir)
    lost = r.where("fail_reason IS NOT NULL").select(F.col("fail_reason").alias("reason"))
    kept = library.validate_combinatorial(r.where("fail_reason IS NULL"), PATTERNS).select(F.coalesce("reason", F.lit("pass")).alias("reason"))
    return lost.unionByName(kept).groupBy("reason").agg(F.count("*").alias("n"))


@query(f"WITH {NNK}, e AS (SELECT CAST(unnest(string_split(mutated, ',')) AS bigint) AS pos FROM val2 WHERE mutated <> '') SELECT i AS pos, count(pos) AS n FROM range(1, 12) t(i) LEFT JOIN e ON pos = i GROUP BY 1")
def mutation_position_report(spark, sf_dir):
    seen = _nnk(spark, sf_dir).select(F.explode(F.col("mutated").cast("array<bigint>")).alias("pos")).groupBy("pos").agg(F.count("*").alias("n"))
    return spark.range(1, 12).withColumnRenamed("id", "pos").join(seen, "pos", "left").select("pos", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


# --- sample sheets -----------------------------------------------------------------------------

_PATH = "concat('/data/', CASE WHEN o_orderkey % 3 = 0 THEN 'run1-1000M/' WHEN o_orderkey % 3 = 1 THEN 'run2-500M/' ELSE '' END, CASE WHEN o_orderkey % 17 = 0 THEN 'notes' ELSE concat('GFB-', cast(o_custkey AS string), '_2510601042_1_clib', o_orderstatus, 'x_S12_L00', cast(o_orderkey % 4 + 1 AS string), '_R1_001') END, '.fastq.gz')"


@query(f"""WITH p AS (SELECT {_PATH} AS fastq FROM orders), q AS (SELECT fastq, string_split(fastq, '/')[-1] AS f FROM p)
SELECT {', '.join(f"nullif(regexp_extract(f, '{fastq.NAME}', {i}), '') AS {n}" for i, n in ((1, 'sample_id'), (3, 'sample_name'), (4, 'lane'), (5, 'read')))}, nullif(regexp_extract(fastq, '/(run\\d+-\\d+M)/', 1), '') AS run_depth, fastq FROM q""")
def sample_sheet_parse(spark, sf_dir):
    return fastq.sample_sheet(_table(spark, sf_dir, "orders").selectExpr(f"{_PATH} AS path"))


# --- statistics --------------------------------------------------------------------------------

REFERENCE = "ACDEFGHIKLM"


@query(f"""WITH s AS ({D.SELECTION}), c AS (SELECT aa_seq, levenshtein(aa_seq, '{REFERENCE}') AS d, count(*) AS n FROM s GROUP BY 1)
SELECT CASE WHEN d >= 5 THEN '4+' ELSE CAST(d AS varchar) END AS bin, CAST(sum(n) AS bigint) AS n, count(*) AS n_variants FROM c GROUP BY 1""")
def edit_distance_bins(spark, sf_dir):
    return stats.distance_bins(D.selection(spark, sf_dir).groupBy("aa_seq").agg(F.count("*").alias("n")), REFERENCE)


@query(f"WITH s AS ({D.SELECTION}), c AS (SELECT peptide, aa_seq, count(*) AS n FROM s GROUP BY 1, 2), w AS (SELECT peptide, aa_seq AS wt FROM c QUALIFY row_number() OVER (PARTITION BY peptide ORDER BY n DESC, aa_seq) = 1) SELECT peptide, wt, CAST(min(levenshtein(aa_seq, wt)) AS bigint) AS least, CAST(max(levenshtein(aa_seq, wt)) AS bigint) AS most, round(avg(levenshtein(aa_seq, wt)), 9) AS mean, CAST(median(levenshtein(aa_seq, wt)) AS double) AS middle FROM c JOIN w USING (peptide) GROUP BY 1, 2")
def wildtype_distance_stats(spark, sf_dir):
    c = D.selection(spark, sf_dir).groupBy("peptide", "aa_seq").agg(F.count("*").alias("n"))
    w = c.groupBy("peptide").agg(F.min(F.struct(-F.col("n"), "aa_seq"))["aa_seq"].alias("wt"))
    d = F.levenshtein("aa_seq", "wt")
    return c.join(w, "peptide").groupBy("peptide", "wt").agg(F.min(d).cast("long").alias("least"), F.max(d).cast("long").alias("most"), F.round(F.avg(d), 9).alias("mean"), F.median(d).alias("middle"))


@query(f"""WITH {REGION}, ok AS (SELECT k, {_translate_sql('region')} AS aa FROM reg WHERE fail_reason IS NULL), w AS (SELECT aa AS ref FROM ok GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
x AS (SELECT k, aa, list_filter(range(1, 12), lambda i: substr(aa, i, 1) <> substr(ref, i, 1)) AS d FROM ok, w)
SELECT k, coalesce(list_max(d) - list_min(d) + 1 <= 4, true) AS within FROM x""")
def tiled_edit_filter(spark, sf_dir):
    ok = _regions(spark, sf_dir).where("fail_reason IS NULL").select("k", "aa")
    w = ok.groupBy("aa").count().agg(F.min(F.struct(-F.col("count"), "aa"))["aa"].alias("ref"))
    d = F.filter(F.sequence(F.lit(1), F.lit(11)), lambda i: F.substr("aa", i, F.lit(1)) != F.substr("ref", i, F.lit(1)))
    return ok.join(F.broadcast(w), how="cross").select("k", F.coalesce(F.array_max(d) - F.array_min(d) + 1 <= 4, F.lit(True)).alias("within"))


@query(f"WITH {WIDE} SELECT peptide, count(*) FILTER (count_pos3x > 0 AND count_pos1x > 0) AS both_, count(*) FILTER (count_pos3x > 0 AND count_pos1x = 0) AS only_3x, count(*) FILTER (count_pos3x = 0 AND count_pos1x > 0) AS only_1x, count(*) FILTER (count_pos3x > 0 OR count_pos1x > 0) AS either FROM wide GROUP BY 1")
def variant_overlap(spark, sf_dir):
    a, b = F.col("count_pos3x") > 0, F.col("count_pos1x") > 0
    return _wide(spark, sf_dir).groupBy("peptide").agg(F.count_if(a & b).alias("both_"), F.count_if(a & ~b).alias("only_3x"), F.count_if(~a & b).alias("only_1x"), F.count_if(a | b).alias("either"))


@query(f"WITH {LABELS}, c AS (SELECT aa_seq FROM labels_ GROUP BY 1 HAVING count(DISTINCT specificity) > 1) SELECT aa_seq, array_to_string(list_sort(list(DISTINCT specificity)), ',') AS labels, count(*) AS n FROM labels_ WHERE aa_seq IN (SELECT aa_seq FROM c) GROUP BY 1")
def label_conflicts(spark, sf_dir):
    g = _labels(spark, sf_dir).groupBy("aa_seq").agg(F.sort_array(F.collect_set("specificity")).alias("l"), F.count("*").alias("n")).where(F.size("l") > 1)
    return g.select("aa_seq", F.array_join(F.transform("l", lambda x: x.cast("string")), ",").alias("labels"), "n")


@query("SELECT event_id, user_id, event_type FROM events QUALIFY event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id)")
def consecutive_collapse(spark, sf_dir):
    return stats.consecutive_collapse(_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type"), "event_id", "event_type", ("user_id",))


@query(f"WITH s AS ({D.SELECTION}) SELECT aa_seq, count(*) AS n FROM s GROUP BY 1 ORDER BY n DESC, aa_seq LIMIT 20")
def topk_variants(spark, sf_dir):
    return D.selection(spark, sf_dir).groupBy("aa_seq").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "aa_seq").limit(20)


POSITIONS = f"{LABELS}, px AS (SELECT peptide, specificity, aa_seq, p - 1 AS pos, substr(aa_seq, p, 1) AS aa FROM (SELECT peptide, specificity, aa_seq, unnest(range(1, 12)) AS p FROM labels_))"


@query(f"WITH {POSITIONS}, g AS (SELECT CAST(pos AS int) AS pos, aa, count(*) AS n FROM px GROUP BY 1, 2) SELECT *, n / sum(n) OVER (PARTITION BY pos) AS share FROM g")
def position_matrix(spark, sf_dir):
    return stats.position_matrix(_labels(spark, sf_dir))


@query(f"""WITH {POSITIONS}, g AS (SELECT CAST(pos AS int) AS pos, aa, count(*) FILTER (specificity = 1) AS a, count(*) FILTER (specificity <> 1) AS b FROM px GROUP BY 1, 2)
SELECT pos, aa, round(log2((coalesce(a / nullif(sum(a) OVER w, 0), 0) + 1e-4) / (coalesce(b / nullif(sum(b) OVER w, 0), 0) + 1e-4)), 9) AS log_odds FROM g WINDOW w AS (PARTITION BY pos)""")
def position_log_odds(spark, sf_dir):
    return stats.position_log_odds(_labels(spark, sf_dir)).withColumn("log_odds", F.round("log_odds", 9))


@query(f"""WITH {LABELS}, p AS (SELECT CAST(a - 1 AS int) AS i, CAST(b - 1 AS int) AS j, substr(aa_seq, a, 1) AS x, substr(aa_seq, b, 1) AS y FROM labels_, range(1, 12) t(a), range(1, 12) u(b) WHERE b - a BETWEEN 1 AND 3),
n AS (SELECT i, j, x, y, count(*) AS n FROM p GROUP BY 1, 2, 3, 4), m AS (SELECT *, sum(n) OVER (PARTITION BY i, j) AS t, sum(n) OVER (PARTITION BY i, j, x) AS na, sum(n) OVER (PARTITION BY i, j, y) AS nb FROM n)
SELECT i, j, round(sum(n / t * ln(n * t / (na * nb))), 6) AS mi FROM m GROUP BY 1, 2""")
def mutual_information(spark, sf_dir):
    return stats.mutual_information(_labels(spark, sf_dir), 3).withColumn("mi", F.round("mi", 6))


@query(f"""WITH {LABELS}, g AS (SELECT substr(aa_seq, 3, 1) AS a, substr(aa_seq, 6, 1) AS b, count(*) FILTER (specificity = 1) AS pos, count(*) FILTER (specificity = 0) AS neg FROM labels_ GROUP BY 1, 2), t AS (SELECT *, sum(pos) OVER () AS tp, sum(neg) OVER () AS tn FROM g)
SELECT a, b, pos, neg, round((coalesce(pos / nullif(tp, 0), 0) + 1e-6) / (coalesce(neg / nullif(tn, 0), 0) + 1e-6), 6) AS enrichment FROM t WHERE pos > 0""")
def pair_enrichment(spark, sf_dir):
    return stats.pair_enrichment(_labels(spark, sf_dir), 2, 5).withColumn("enrichment", F.round("enrichment", 6))


@query(f"""WITH {LABELS} SELECT CAST((a - 1) // 4 AS bigint) AS tile, CAST(a - 1 AS int) AS start, CAST(b - a - 1 AS int) AS gap, substr(aa_seq, a, 1) AS a, substr(aa_seq, b, 1) AS b, count(*) AS n
FROM labels_, range(1, 12) t(a), range(1, 12) u(b) WHERE b - a BETWEEN 1 AND 3 AND (a - 1) // 4 = (b - 1) // 4 GROUP BY ALL""")
def gapped_motifs(spark, sf_dir):
    return stats.gapped_motifs(_labels(spark, sf_dir))


@query(f"""WITH {POSITIONS}, grid AS (SELECT unnest(range(0, 11)) AS pos, a AS aa FROM (SELECT unnest(string_split('{S.AMINO_LETTERS}', '')) AS a)),
g AS (SELECT CAST(grid.pos AS int) AS pos, grid.aa, round(ln((count(*) FILTER (specificity = 1) + 1) / (count(*) FILTER (specificity = 0) + 1)), 9) AS log_ratio FROM grid LEFT JOIN px ON grid.pos = px.pos AND grid.aa = px.aa GROUP BY 1, 2)
SELECT pos, aa, log_ratio FROM g QUALIFY row_number() OVER (PARTITION BY pos ORDER BY log_ratio DESC, instr('{S.AMINO_LETTERS}', aa)) = 1""")
def top_anchor_residue(spark, sf_dir):
    return stats.top_residue(_labels(spark, sf_dir), S.AMINO_LETTERS)


@query(f"WITH {POSITIONS}, g AS (SELECT CAST(pos AS int) AS pos, aa, count(*) AS n FROM px WHERE substr(aa_seq, 6, 1) = 'K' GROUP BY 1, 2) SELECT *, n / sum(n) OVER (PARTITION BY pos) AS share FROM g WHERE abs(pos - 5) BETWEEN 1 AND 3")
def anchor_cooccurrence(spark, sf_dir):
    return stats.cooccurrence(_labels(spark, sf_dir), 5, "K")


@query(f"WITH {POSITIONS}, g AS (SELECT aa, count(*) AS n FROM px GROUP BY 1) SELECT *, n / sum(n) OVER () AS share FROM g")
def aa_composition(spark, sf_dir):
    g = stats.positions(_labels(spark, sf_dir)).groupBy("aa").agg(F.count("*").alias("n"))
    return g.crossJoin(F.broadcast(g.agg(F.sum("n").alias("t")))).select("aa", "n", (F.col("n") / F.col("t")).alias("share"))


@query(f"WITH s AS ({D.SELECTION}), v AS (SELECT DISTINCT aa_seq FROM s), k AS (SELECT * FROM (VALUES {', '.join(f"('{a}', {v}::double)" for a, v in P.HYDROPATHY.items())}) t(aa, h)), x AS (SELECT aa_seq, substr(aa_seq, p, 1) AS aa FROM (SELECT aa_seq, unnest(range(1, 12)) AS p FROM v)) SELECT aa_seq, round(avg(h), 6) AS gravy, round(avg(CAST(aa IN ('F', 'W', 'Y') AS int)), 6) AS aromaticity FROM x JOIN k USING (aa) GROUP BY 1")
def gravy(spark, sf_dir):
    v = D.selection(spark, sf_dir).select("aa_seq").distinct()
    return v.select("aa_seq", F.round(P.gravy("aa_seq"), 6).alias("gravy"), F.round(P.aromaticity("aa_seq"), 6).alias("aromaticity"))


@query(f"WITH {LABELS} SELECT pos_vs_lib_status, count(*) AS n, round(avg(count_pos3x), 6) AS mean, round(stddev_samp(count_pos3x), 6) AS sd, min(count_pos3x) AS min, quantile_cont(count_pos3x, 0.25) AS q1, quantile_cont(count_pos3x, 0.5) AS q2, quantile_cont(count_pos3x, 0.75) AS q3, max(count_pos3x) AS max FROM labels_ GROUP BY 1")
def describe_by_status(spark, sf_dir):
    d = stats.describe(_labels(spark, sf_dir), "pos_vs_lib_status", "count_pos3x")
    return d.withColumn("mean", F.round("mean", 6)).withColumn("sd", F.round("sd", 6))


@query(f"""WITH {WIDE}, r AS (SELECT peptide, rank() OVER (PARTITION BY peptide ORDER BY count_pos3x) + (count(*) OVER (PARTITION BY peptide, count_pos3x) - 1) / 2 AS x, rank() OVER (PARTITION BY peptide ORDER BY count_lib) + (count(*) OVER (PARTITION BY peptide, count_lib) - 1) / 2 AS y FROM wide)
SELECT peptide, round(corr(x, y), 6) AS rho, count(*) AS n FROM r GROUP BY 1""")
def spearman_corr(spark, sf_dir):
    return stats.spearman(_wide(spark, sf_dir), "count_pos3x", "count_lib", "peptide").withColumn("rho", F.round("rho", 6))


# --- learning ----------------------------------------------------------------------------------

SCORED = "SELECT o_orderkey AS id, o_orderpriority AS grp, CAST(o_orderstatus = 'F' AS int) AS label, round(o_totalprice / 1000) AS score FROM orders"


def _scored(spark, sf_dir):
    return D.view(spark, sf_dir, SCORED, "orders")


@query(f"WITH s AS ({SCORED}) SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(id AS varchar)), id) <= floor(0.2 * count(*) OVER (PARTITION BY label)) AS test FROM s")
def stratified_split(spark, sf_dir):
    return ml.stratified_split(_scored(spark, sf_dir).select("id", "label"), "label", "id")


@query(f"""WITH s AS ({SCORED}), n AS (SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(id AS varchar)), id) AS n, count(*) FILTER (label = 1) OVER () AS a, count(*) FILTER (label = 0) OVER () AS b FROM s)
SELECT id, label FROM n WHERE n <= CASE WHEN label = 1 THEN b ELSE a END""")
def resample_balance(spark, sf_dir):
    return ml.balance(_scored(spark, sf_dir).select("id", "label"), "label", "id")


@query(f"WITH s AS ({SCORED}), r AS (SELECT grp, label, rank() OVER (PARTITION BY grp ORDER BY score) + (count(*) OVER (PARTITION BY grp, score) - 1) / 2 AS r FROM s), g AS (SELECT grp, sum(r) FILTER (label = 1) AS s, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS q FROM r GROUP BY 1) SELECT grp, round((s - p * (p + 1) / 2) / (p * q), 9) AS auroc FROM g")
def auroc_rank(spark, sf_dir):
    return ml.auroc(_scored(spark, sf_dir), "grp", "label", "score").withColumn("auroc", F.round("auroc", 9))


@query(f"WITH s AS ({SCORED}), g AS (SELECT grp, score, sum(label) AS p, count(*) AS n FROM s GROUP BY 1, 2), w AS (SELECT grp, p, sum(p) OVER o / sum(n) OVER o AS prec FROM g WINDOW o AS (PARTITION BY grp ORDER BY score DESC)) SELECT grp, round(sum(p * prec) / sum(p), 9) AS ap FROM w GROUP BY 1")
def average_precision(spark, sf_dir):
    return ml.average_precision(_scored(spark, sf_dir), "grp", "label", "score").withColumn("ap", F.round("ap", 9))


@query(f"""WITH s AS ({SCORED}), g AS (SELECT grp, count(*) FILTER (label = 1 AND score >= 100) AS tp, count(*) FILTER (label = 0 AND score >= 100) AS fp, count(*) FILTER (label = 1 AND score < 100) AS fn, count(*) FILTER (label = 0 AND score < 100) AS tn FROM s GROUP BY 1)
SELECT *, round((tp + tn) / (tp + fp + fn + tn), 9) AS accuracy, round(tp / (tp + fp), 9) AS precision, round(tp / (tp + fn), 9) AS recall, round(2 * tp / (2 * tp + fp + fn), 9) AS f1, round((tp::double * tn - fp::double * fn) / sqrt((tp + fp)::double * (tp + fn) * (tn + fp) * (tn + fn)), 9) AS mcc FROM g""")
def confusion_mcc(spark, sf_dir):
    c = ml.confusion(_scored(spark, sf_dir), "grp", "label", "score", 100)
    return c.withColumns({n: F.round(n, 9) for n in ("accuracy", "precision", "recall", "f1", "mcc")})

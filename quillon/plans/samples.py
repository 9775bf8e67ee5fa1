"""Queries of samples: names, sheets, condition files, reports and sinks."""

from pyspark.sql import functions as F

from quillon.functions import names as N, seq as S
from quillon.operators import label, library, trim
from quillon.plans import derived as D
from quillon.plans.catalog import ANCHOR, COMB, NNK, PATTERNS, WILDTYPE, _PATH, _nnk, _regions, _table
from quillon.plans.registry import query
from quillon.session import work_path
from quillon.sources import fastq, tables

_NAME = fastq.NAME
_SHEET = f"""p AS (SELECT {_PATH} AS fastq FROM orders), q AS (SELECT fastq, string_split(fastq, '/')[-1] AS f FROM p),
sheet AS (SELECT {', '.join(f"nullif(regexp_extract(f, '{_NAME}', {i}), '') AS {n}" for i, n in ((1, 'sample_id'), (3, 'sample_name'), (4, 'lane'), (5, 'read')))}, nullif(regexp_extract(fastq, '/(run\\d+-\\d+M)/', 1), '') AS run_depth, fastq FROM q)"""


def _sheet(spark, sf_dir, **options):
    return fastq.sample_sheet(_table(spark, sf_dir, "orders").selectExpr(f"{_PATH} AS path"), **options)


@query(f"WITH {_SHEET} SELECT fastq, count(*) AS n FROM sheet WHERE sample_id IS NULL GROUP BY 1")
def sample_sheet_unmatched(spark, sf_dir):
    return _sheet(spark, sf_dir).where("sample_id IS NULL").groupBy("fastq").agg(F.count("*").alias("n"))


@query(f"WITH {_SHEET} SELECT sample_id, sample_name, lane, read, fastq FROM (SELECT *, row_number() OVER (ORDER BY sample_id, sample_name, lane, read, fastq) AS place FROM (SELECT DISTINCT * FROM sheet WHERE sample_id IS NOT NULL)) WHERE place <= 500")
def sample_sheet_first(spark, sf_dir):
    """The first 500 files in the order of the sheet: a top-k, not a cut of the input."""
    sheet = _sheet(spark, sf_dir).where("sample_id IS NOT NULL").distinct()
    return sheet.orderBy(*fastq.sheet_order(), "fastq").limit(500).select("sample_id", "sample_name", "lane", "read", "fastq")


@query(f"WITH {_SHEET} SELECT sample_id, sample_name, lane, read, '' AS run_depth, fastq FROM sheet WHERE sample_id IS NOT NULL")
def sample_sheet_variant(spark, sf_dir):
    return _sheet(spark, sf_dir, run_depth=False).where("sample_id IS NOT NULL")


_READS = "SELECT concat('S', cast(o_custkey % 500 AS string)) AS sample_id, concat('n', cast(o_custkey % 500 AS string)) AS sample_name, cast(o_orderkey % 4 + 1 AS string) AS lane, CASE WHEN o_orderkey % 3 = 0 THEN '2' ELSE '1' END AS read, concat('f', cast(o_orderkey AS string)) AS fastq FROM orders"


@query(f"WITH s AS ({_READS}), a AS (SELECT sample_id, sample_name, lane, min(fastq) AS r1 FROM s WHERE read = '1' GROUP BY ALL), b AS (SELECT sample_id, sample_name, lane, min(fastq) AS r2 FROM s WHERE read = '2' GROUP BY ALL) SELECT * FROM a LEFT JOIN b USING (sample_id, sample_name, lane)")
def read_pairs(spark, sf_dir):
    return fastq.read_pairs(D.view(spark, sf_dir, _READS, "orders"))


#: Names with blanks around them, without any, and several for some ids.
_MESSY = "SELECT CASE WHEN o_orderkey % 19 = 0 THEN ' ' ELSE concat(' S', cast(o_custkey % 700 AS string)) END AS sample_id, CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE concat('name ', cast(o_custkey % 700 % 9 AS string), CASE WHEN o_custkey % 700 % 50 = 0 THEN o_orderstatus ELSE '' END, ' ') END AS sample_name, o_orderkey AS line FROM orders"


def _messy(spark, sf_dir):
    return D.view(spark, sf_dir, _MESSY, "orders")


@query(f"WITH s AS ({_MESSY}) SELECT DISTINCT trim(sample_id) AS sample_id, trim(sample_name) AS sample_name FROM s WHERE trim(sample_id) <> '' AND trim(sample_name) <> ''")
def sample_pairs(spark, sf_dir):
    return tables.samples_of(_messy(spark, sf_dir))


@query(f"WITH s AS ({_MESSY}) SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY sample_id, sample_name ORDER BY line) = 1")
def sample_sheet_dedupe(spark, sf_dir):
    return tables.first_of(_messy(spark, sf_dir), ["sample_id", "sample_name"], "line")


@query(f"WITH s AS ({_MESSY}) SELECT trim(sample_id) AS sample_id, arg_min(coalesce(trim(sample_name), '?'), line) AS sample_name FROM s GROUP BY 1")
def sample_name_lookup(spark, sf_dir):
    return tables.sample_names(_messy(spark, sf_dir).na.fill("?", ["sample_name"]), "line")


@query(f"WITH s AS ({_MESSY}) SELECT sample_id, array_to_string(list_sort(list(DISTINCT sample_name)), ',') AS names FROM s WHERE sample_name IS NOT NULL GROUP BY 1 HAVING count(DISTINCT sample_name) > 1")
def sample_name_conflicts(spark, sf_dir):
    return tables.name_conflicts(_messy(spark, sf_dir))


@query(f"WITH {_SHEET} SELECT * FROM sheet WHERE sample_id = 'GFB-1'")
def single_sample(spark, sf_dir):
    return tables.one_sample(_sheet(spark, sf_dir), "GFB-1", strict=False)


#: Files of conditions, several for some of them.
_FILES = "SELECT concat('/x/run', cast(p_partkey % 4 AS string), '_', 'v') AS folder, concat('clib', p_brand, CASE p_size % 5 WHEN 0 THEN 'originallib' WHEN 1 THEN '_2xnegative' WHEN 2 THEN '3xpositive' WHEN 3 THEN '31xpositive' ELSE 'other' END) AS stem, p_partkey FROM part"


@query(f"""WITH f AS ({_FILES}), n AS (SELECT concat(stem, '.', cast(p_partkey % 7 AS varchar), '.tsv') AS name, concat(folder, '/', stem, '.', cast(p_partkey % 7 AS varchar), '.tsv') AS path, stem FROM f),
c AS (SELECT path, name, regexp_replace(regexp_replace(stem, '^clib', ''), '[.][0-9]$', '') AS t FROM n),
d AS (SELECT path, name, CASE WHEN t LIKE '%originallib' THEN 'lib' WHEN t LIKE '%2xnegative' THEN 'neg' WHEN t LIKE '%31xpositive' THEN 'pos1x' WHEN t LIKE '%3xpositive' THEN 'pos3x' END AS condition,
    regexp_replace(regexp_replace(t, '(originallib|2xnegative|31xpositive|3xpositive)$', ''), '[-_]+$', '') AS peptide FROM c)
SELECT peptide, condition, max(path) AS file FROM d WHERE condition IS NOT NULL AND name = (SELECT max(name) FROM d e WHERE e.peptide = d.peptide AND e.condition = d.condition) GROUP BY 1, 2""")
def condition_files_last(spark, sf_dir):
    f = D.view(spark, sf_dir, _FILES, "part").selectExpr("concat(folder, '/', stem, '.', cast(p_partkey % 7 AS string), '.tsv') AS path")
    parse = lambda name: label.parse_condition(F.regexp_replace(name, "[.][0-9]$", ""))
    files = f.groupBy(F.element_at(F.split("path", "/"), -1).alias("name")).agg(F.max("path").alias("path"))
    return tables.condition_files(files, parse)


@query("""WITH s AS (SELECT p_partkey, concat('clib', CASE WHEN p_size % 3 = 0 THEN '' ELSE p_brand END, CASE p_size % 2 WHEN 0 THEN 'originallib' ELSE '2xnegative' END) AS s FROM part)
SELECT p_partkey, CASE WHEN s = 'cliboriginallib' THEN 'lib' WHEN s LIKE '%2xnegative' THEN CASE WHEN s = 'clib2xnegative' THEN 'peptide' ELSE replace(substr(s, 5), '2xnegative', '') END END AS peptide,
    CASE WHEN s = 'cliboriginallib' THEN 'lib' WHEN s LIKE '%2xnegative' THEN 'neg' END AS condition FROM s""")
def condition_token_exact_lib(spark, sf_dir):
    peptide, condition = label.parse_condition(F.col("s"), exact_lib=True)
    s = _table(spark, sf_dir, "part").selectExpr("p_partkey", "concat('clib', CASE WHEN p_size % 3 = 0 THEN '' ELSE p_brand END, CASE p_size % 2 WHEN 0 THEN 'originallib' ELSE '2xnegative' END) AS s")
    return s.select("p_partkey", peptide.alias("peptide"), condition.alias("condition"))


_RAW = "concat(' ', p_name, ' /', p_brand, CASE p_size % 3 WHEN 0 THEN '.fastq.gz' WHEN 1 THEN '.fq.gz' ELSE '' END)"


@query(f"""WITH r AS (SELECT p_partkey, {_RAW} AS s FROM part)
SELECT p_partkey, regexp_replace(trim(s), '[ /]', '_', 'g') AS safe, coalesce(nullif(trim(regexp_replace(trim(s), '[^A-Za-z0-9._-]+', '_', 'g'), '_'), ''), 'unknown') AS token,
    coalesce(nullif(trim(regexp_replace(s, '[^A-Za-z0-9._-]+', '_', 'g'), '_'), ''), 'peptide') AS output,
    CASE WHEN s LIKE '%.fastq.gz' THEN replace(s, '.fastq.gz', '.trimmed.fastq.gz') WHEN s LIKE '%.fq.gz' THEN replace(s, '.fq.gz', '.trimmed.fq.gz') ELSE s || '.trimmed.fastq.gz' END AS trimmed FROM r""")
def file_names(spark, sf_dir):
    r = _table(spark, sf_dir, "part").selectExpr("p_partkey", f"{_RAW} AS s")
    return r.select("p_partkey", S.safe_name("s").alias("safe"), S.sanitize("s").alias("token"), label.output_name(F.col("s")).alias("output"), S.trimmed_name("s").alias("trimmed"))


#: Sample names of several schemes, some misspelt.
_NAMES = """SELECT p_partkey, concat(CASE p_partkey % 9 WHEN 0 THEN concat('GIG0', cast(p_size % 30 AS string)) WHEN 1 THEN concat('drg ', cast(p_size AS string), '_') WHEN 2 THEN 'KH158' WHEN 3 THEN 'kh-160 ' WHEN 4 THEN 'MAGE-A3' WHEN 5 THEN 'mageA3 ' WHEN 6 THEN 'TININ' WHEN 7 THEN 'x_titin_' ELSE 'other' END,
    CASE p_size % 8 WHEN 0 THEN '2xnegative' WHEN 1 THEN '3x positve' WHEN 2 THEN '31xPOISITIVE' WHEN 3 THEN '2xpositive' WHEN 4 THEN '1xNegtaive' WHEN 5 THEN ' 4 x negative' WHEN 6 THEN 'originallib' ELSE '' END) AS name FROM part"""
_CLEAN = "regexp_replace(regexp_replace(regexp_replace(upper(e), '[\\s_,-]+', '', 'g'), 'POISITIVE|POITIVE|POSITVE', 'POSITIVE'), 'NEGAITIVE|NEGTAIVE', 'NEGATIVE')"


@query(f"""WITH n AS ({_NAMES}), u AS (SELECT p_partkey, upper(name) AS s FROM n),
t AS (SELECT p_partkey, s, regexp_matches(s, 'GIG\\s*0*\\d+|DRG\\s*0*\\d+') AS legacy, regexp_matches(s, 'KH\\s*[-_ ]?\\d{{3}}|MAGE[-_ ]?A?3|TITIN|TININ') AS kh,
    regexp_extract(s, '(\\d+)\\s*X\\s*{N.TOKEN}', 0) AS e0 FROM u)
SELECT p_partkey, CASE WHEN legacy THEN 'legacy' WHEN kh AND (NOT contains(s, 'MAGE') OR regexp_matches(s, '\\bMAGE[-_ ]?A?3\\b')) THEN 'kh_style' ELSE 'unknown' END AS scheme FROM t""")
def name_scheme(spark, sf_dir):
    return D.view(spark, sf_dir, _NAMES, "part").select("p_partkey", N.scheme("name").alias("scheme"))


@query()
def name_parse(spark, sf_dir):
    """Protein, enrichment and their order; held against a plain parser in the tests."""
    n = D.view(spark, sf_dir, _NAMES, "part").withColumn("x", N.protein_and_enrichment("name"))
    return n.select("p_partkey", "name", "x.*", N.enrichment_rank(F.col("x.enrichment"), F.col("x.protein")).alias("rank"), N.protein_order(F.col("x.protein"))["class"].alias("protein_class"), N.protein_order(F.col("x.protein"))["number"].alias("protein_number"))


# --- reports ---------------------------------------------------------------------------------------

_COUNTS = "SELECT o_custkey % 40 AS sample, CAST(count(*) AS bigint) AS total, count_if(o_orderstatus = 'F') AS short_, count_if(o_orderstatus = 'O') AS none_, count_if(o_orderpriority LIKE '1%') AS wrong_ FROM orders GROUP BY 1"
_REPORT = f"""SELECT cast(sample AS string) AS sample, concat('Sample: ', cast(sample AS string), chr(10), '  Total reads  processed: ', cast(total AS string), chr(13), chr(10), 'Reads too short for spacer+UMI+anchor (dropped): ', cast(short_ AS string), chr(10),
    'Reads with no anchor found (dropped): ', cast(none_ AS string), chr(10), chr(10), 'UMIs with >= 2 reads (consensus): ', cast(wrong_ AS string), chr(10), 'Reads contributing to consensus UMIs: ', cast(wrong_ AS string)) AS text FROM ({_COUNTS}) c"""


@query(f"""WITH c AS ({_COUNTS.replace('count_if', 'count_if')}) SELECT CAST(sample AS varchar) AS sample, total AS total_reads, CAST(short_ AS bigint) AS dropped_too_short, CAST(none_ AS bigint) AS dropped_no_anchor, 0::bigint AS dropped_anchor_invalid, 0::bigint AS dropped_empty_insert,
    CAST(wrong_ AS bigint) AS reads_consensus, 0::bigint AS reads_singletons, NULL::bigint AS total_umis, CAST(wrong_ AS bigint) AS umis_ge2, NULL::bigint AS umis_singletons, CAST(short_ + none_ AS bigint) AS dropped_total,
    CAST(total - short_ - none_ AS bigint) AS kept_after_anchor, CAST(total - short_ - none_ - wrong_ AS bigint) AS reads_other_kept FROM c""")
def umi_report_parse(spark, sf_dir):
    return tables.umi_report(D.view(spark, sf_dir, _REPORT, "orders"))


_STACK = f"""SELECT cast(sample AS string) AS sample, concat('# made', chr(10), 'metric', chr(9), 'value', chr(10), 'total_reads', chr(9), cast(total AS string), chr(10), '#pass 3', chr(10), 'pass', chr(9), cast(short_ AS string), chr(10), 'rate', chr(9), '0.5', chr(10), chr(10),
    'mutated_position_1based', chr(9), 'count', chr(10), '1', chr(9), cast(none_ AS string), chr(10), '11', chr(9), cast(wrong_ AS string), chr(10)) AS text FROM ({_COUNTS}) c"""


@query(f"""WITH c AS ({_COUNTS}) SELECT CAST(sample AS varchar) AS sample, 'metric' AS block, 'total_reads' AS name, total AS value FROM c UNION ALL SELECT CAST(sample AS varchar), 'metric', 'pass', CAST(short_ AS bigint) FROM c
UNION ALL SELECT CAST(sample AS varchar), 'position', '1', CAST(none_ AS bigint) FROM c UNION ALL SELECT CAST(sample AS varchar), 'position', '11', CAST(wrong_ AS bigint) FROM c""")
def stacked_summary_parse(spark, sf_dir):
    return tables.stacked_summary(D.view(spark, sf_dir, _STACK, "orders"))


@query(f"WITH c AS ({_COUNTS}) SELECT CAST(sample AS bigint) AS sample, concat('Sample: ', sample, chr(10), 'total: ', total, chr(10), 'short_: ', short_) AS text FROM c")
def summary_text(spark, sf_dir):
    c = D.view(spark, sf_dir, _COUNTS, "orders").select("sample", "total", "short_")
    return tables.report_text(c, ["sample"])


# --- sinks, read back --------------------------------------------------------------------------------


@query(f"WITH {COMB} SELECT CASE WHEN coalesce(fail_reason, reason) IS NULL THEN 'pass' ELSE 'fail' END AS part, coalesce(fail_reason, reason) AS reason, count(*) AS n FROM reg LEFT JOIN val USING (k) GROUP BY ALL")
def pass_fail_split(spark, sf_dir):
    r = library.strategy("combinatorial", PATTERNS)(_regions(spark, sf_dir))
    path = work_path(spark, "pass-fail")
    tables.write_pass_fail(r.withColumn("fail_reason", F.coalesce("fail_reason", "reason")).drop("reason"), path)
    none = F.lit(None).cast("string")
    passed = spark.read.parquet(f"{path}/pass").select(F.lit("pass").alias("part"), none.alias("reason"))
    failed = spark.read.parquet(f"{path}/fail").select(F.lit("fail").alias("part"), F.col("fail_reason").alias("reason"))
    return passed.unionByName(failed).groupBy("part", "reason").agg(F.count("*").alias("n"))


_METRICS = f"SELECT cast(sample AS string) AS sample_id, concat('n', cast(sample AS string)) AS sample_name, total, short_ FROM ({_COUNTS}) c"


@query(f"WITH m AS ({_METRICS}) SELECT sample_id, sample_name, step, metric, CAST(value AS double) AS value FROM (SELECT sample_id, sample_name, '01' AS step, 'total' AS metric, total AS value FROM m UNION ALL SELECT sample_id, sample_name, '02', 'short_', short_ FROM m)")
def metrics_append(spark, sf_dir):
    m, path = D.view(spark, sf_dir, _METRICS, "orders"), work_path(spark, "metrics")
    for step, metric in (("01", "total"), ("02", "short_")):
        tables.append_metrics(trim.long_metrics(m.select("sample_id", "sample_name", metric), ["sample_id", "sample_name"], step), path)
    return tables.read_metrics(spark, path)


@query("SELECT CAST(o_orderkey AS varchar) AS k, o_orderstatus AS s, o_orderpriority AS p FROM orders")
def table_round_trip(spark, sf_dir):
    path = work_path(spark, "table")
    t = _table(spark, sf_dir, "orders").selectExpr("cast(o_orderkey AS string) AS k", "o_orderstatus AS s", "o_orderpriority AS p")
    tables.write_table(t, path, partition_by=("s",), order=("k",))
    return spark.read.option("header", True).option("sep", "\t").schema("k string, p string, s string").csv(path)


@query(f"WITH {_SHEET}, one AS (SELECT sample_id, min(sample_name) AS name, list_sort(list(DISTINCT fastq)) AS files FROM sheet WHERE sample_id IS NOT NULL GROUP BY 1) SELECT sample_id, concat('min_length: 50', chr(10), 'quality: 20', chr(10), 'sample_id: ''', sample_id, '''', chr(10), 'sample_name: ''', name, '''', chr(10), 'fastq:', chr(10), array_to_string([concat('- ''', f, '''') FOR f IN files], chr(10)), chr(10)) AS yaml FROM one")
def sample_configs(spark, sf_dir):
    return tables.sample_configs(_sheet(spark, sf_dir).where("sample_id IS NOT NULL"), {"quality": 20, "min_length": 50})


@query(f"WITH reads AS ({D.READS}) SELECT concat(k, '-', read_no) AS read_id, seq, qual FROM reads")
def fastq_round_trip(spark, sf_dir):
    """All reads as gzip FASTQ files, a lane each, and back."""
    r = D.reads(spark, sf_dir).select(F.concat_ws("-", "k", "read_no").alias("read_id"), "seq", "qual")
    path = work_path(spark, "fastq")
    fastq.write_fastq(r, path)
    # a file a task that wrote one
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path").collect()
    return fastq.read_fastq(spark, [f.path for f in files]).select("read_id", "seq", "qual")


# --- extraction summaries ------------------------------------------------------------------------------


@query(f"WITH {COMB} SELECT i AS pos, count(fail_pos) AS n FROM range(1, 12) t(i) LEFT JOIN val ON fail_pos = i GROUP BY 1")
def fail_position_report(spark, sf_dir):
    v = library.validate_combinatorial(_regions(spark, sf_dir).where("fail_reason IS NULL"), PATTERNS)
    seen = v.where("fail_pos IS NOT NULL").groupBy(F.col("fail_pos").alias("pos")).agg(F.count("*").alias("n"))
    return spark.range(1, 12).withColumnRenamed("id", "pos").join(seen, "pos", "left").select("pos", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


@query(f"WITH {NNK} SELECT i AS mutations, count(n) AS n FROM range(0, (SELECT max(n) + 1 FROM val2)) t(i) LEFT JOIN val2 ON n = i GROUP BY 1")
def mutation_count_report(spark, sf_dir):
    seen = _nnk(spark, sf_dir).groupBy(F.size("mutated").cast("long").alias("mutations")).agg(F.count("*").alias("n"))
    grid = seen.agg(F.max("mutations").alias("m")).select(F.explode(F.sequence(F.lit(0).cast("long"), "m")).alias("mutations"))
    return grid.join(seen, "mutations", "left").select("mutations", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


LOST = {"reads_lost_no_anchor": ("anchor_not_found",), "reads_lost_too_short": ("region_too_short",), "reads_lost_contains_N": ("contains_N",), "reads_lost_stop_codon": ("stop_codon",), "reads_lost_validation": ("degenerate_mismatch", "too_many_mutations", "mutation_not_NNK")}
_REASONS = f"{COMB}, rs AS (SELECT k % 5 AS sample, coalesce(fail_reason, reason) AS why FROM reg LEFT JOIN val USING (k))"


def _reasons(spark, sf_dir):
    r = library.validate_combinatorial(_regions(spark, sf_dir), PATTERNS)
    return r.select((F.col("k") % 5).alias("sample"), F.coalesce("fail_reason", "reason").alias("why"))


@query(f"""WITH {_REASONS}, fx AS (SELECT sample, CAST(count(*) AS double) AS reads_in_total, CAST(count(*) FILTER (why IS NULL) AS double) AS reads_pass, {', '.join(f"CAST(count(*) FILTER (why IN ({', '.join(map(repr, rs))})) AS double) AS {m}" for m, rs in LOST.items())} FROM rs GROUP BY 1)
SELECT sample, metric, value, '03_extraction' AS step FROM (UNPIVOT fx ON COLUMNS(* EXCLUDE sample) INTO NAME metric VALUE value)""")
def funnel_extraction(spark, sf_dir):
    return trim.reason_metrics(_reasons(spark, sf_dir), ["sample"], "why", "03_extraction", "reads_in_total", "reads_pass", LOST)


@query(f"""WITH {_REASONS} SELECT sample, CAST(count(*) FILTER (why IS NULL) AS double) AS pass, CAST(count(*) AS double) AS total_reads, {', '.join(f"CAST(count(*) FILTER (why = '{r}') AS double) AS fail_{r}" for r in ('anchor_not_found', 'contains_N', 'degenerate_mismatch', 'region_too_short', 'stop_codon'))},
    count(*) FILTER (why IS NULL) / count(*) AS pass_rate, CAST(count(why) AS double) AS total_fail FROM rs GROUP BY 1""")
def extraction_pass_table(spark, sf_dir):
    r = _reasons(spark, sf_dir)
    every = r.groupBy("sample").agg(F.count("*").cast("double").alias("value")).withColumn("metric", F.lit("total_reads"))
    each = r.groupBy("sample", F.coalesce(F.concat(F.lit("fail_"), "why"), F.lit("pass")).alias("metric")).agg(F.count("*").cast("double").alias("value"))
    return trim.pass_table(each.unionByName(every), ["sample"])


@query(f"""WITH {NNK}, e AS (SELECT k % 5 AS sample, CAST(unnest(string_split(mutated, ',')) AS bigint) AS pos FROM val2 WHERE mutated <> '')
SELECT sample, {', '.join(f'count(*) FILTER (pos = {i}) AS p{i}' for i in range(1, 12))} FROM e GROUP BY 1""")
def position_pivot(spark, sf_dir):
    e = _nnk(spark, sf_dir).select((F.col("k") % 5).alias("sample"), F.explode("mutated").alias("pos"))
    wide = e.groupBy("sample").pivot("pos", list(range(1, 12))).count().na.fill(0)
    return wide.select("sample", *[F.col(str(i)).alias(f"p{i}") for i in range(1, 12)])


# --- regions between adapters ------------------------------------------------------------------------------

START, END = "AC", "GT"
_BETWEEN = f"""r AS ({D.REGIONS}), a AS (SELECT k, seq, instr(seq, '{START}') - 1 AS f, instr(seq, '{END}') - 1 AS t FROM r),
b AS (SELECT *, CASE WHEN f >= 0 AND f < t THEN substr(seq, f + 3, greatest(t - f - 2, 0)) END AS between_ FROM a)"""


@query(f"WITH {_BETWEEN} SELECT k, f AS from_, t AS to_, between_ AS between FROM b")
def adapter_extract(spark, sf_dir):
    return library.extract_between(D.regions(spark, sf_dir), START, END).select("k", "from_", "to_", "between")


_HIT = lambda a, c: f"coalesce(list_min(list_filter(range(1, CAST(length(seq) - {len(a) - 2} AS bigint)), lambda i: hamming(substr(seq, i, {len(a)}), '{a}') <= 1)), 0) - 1 AS {c}"


@query(f"""WITH r AS ({D.REGIONS}), a AS (SELECT k, seq, {_HIT('ACGTA', 'f')}, {_HIT('GGTCA', 't')} FROM r)
SELECT k, CAST(f AS int) AS from_, CAST(t AS int) AS to_, CASE WHEN f >= 0 AND f < t THEN substr(seq, f + 6, greatest(t - f - 5, 0)) END AS between FROM a""")
def adapter_extract_approx(spark, sf_dir):
    return library.extract_between(D.regions(spark, sf_dir), "ACGTA", "GGTCA", substitutions=1).select("k", "from_", "to_", "between")


@query(f"WITH {_BETWEEN} SELECT length(between_) AS length, count(*) AS n FROM b WHERE between_ IS NOT NULL AND length(between_) = 9 AND between_ <> 'ACGACGACG' GROUP BY 1")
def adapter_filter(spark, sf_dir):
    r = library.extract_between(D.regions(spark, sf_dir), START, END).where("between IS NOT NULL AND length(between) = 9 AND between <> 'ACGACGACG'")
    return r.groupBy(F.length("between").cast("long").alias("length")).agg(F.count("*").alias("n"))


_CODONS = f"""{_BETWEEN}, c AS (SELECT k, f, t, between_, CASE WHEN f < 0 OR t < 0 THEN 'no_anchor' WHEN t <= f + 2 THEN 'end_before_start' WHEN length(between_) < 6 THEN 'region_too_short' END AS reason FROM b)"""


@query(f"WITH {_CODONS} SELECT k, reason, CASE WHEN reason IS NULL THEN substr(between_, 1, 6) END AS nt_seq FROM c")
def codon_extract(spark, sf_dir):
    return library.extract_codons(D.regions(spark, sf_dir), START, END, 2).select("k", "reason", "nt_seq")


@query(f"""WITH {_CODONS}, v AS (SELECT 'start' AS what, CAST(f AS bigint) AS v FROM c WHERE f >= 0 UNION ALL SELECT 'end', t FROM c WHERE t >= 0 UNION ALL SELECT 'length', length(between_) FROM c WHERE f >= 0 AND t > f AND length(between_) > 0),
g AS (SELECT what, list_sort(list(v)) AS l FROM v GROUP BY 1) SELECT what, CAST(len(l) AS bigint) AS n, l[1] AS least, l[len(l) // 2 + 1] AS median, l[-1] AS most FROM g""")
def codon_extract_stats(spark, sf_dir):
    return library.extraction_stats(library.extract_codons(D.regions(spark, sf_dir), START, END, 2))


_WT = "GCCAGC"


@query(f"""WITH {_BETWEEN}, n AS (SELECT substr(between_, 1, 6) AS nt, count(*) AS n FROM b WHERE length(between_) >= 6 GROUP BY 1), m AS (SELECT nt, n FROM n WHERE nt <> '{_WT}' AND n >= 2),
aas AS (SELECT split_part(concat({', '.join(f"CASE WHEN regexp_full_match(substr(nt, {3 * i + 1}, 3), '[ACGT]{{3}}') THEN substr('{S.AMINO}', 16 * (instr('TCAG', substr(nt, {3 * i + 1}, 1)) - 1) + 4 * (instr('TCAG', substr(nt, {3 * i + 2}, 1)) - 1) + instr('TCAG', substr(nt, {3 * i + 3}, 1)), 1) ELSE 'X' END" for i in range(2))}), '*', 1) AS aa, n FROM m)
SELECT aa, CAST(sum(n) AS bigint) AS n, CAST(levenshtein(aa, 'AS') AS int) AS distance FROM aas WHERE length(aa) = 2 GROUP BY 1""")
def variant_threshold_distance(spark, sf_dir):
    r = library.extract_between(D.regions(spark, sf_dir), START, END).where("length(between) >= 6").withColumn("between", F.substring("between", 1, 6))
    return library.variant_counts(r, _WT)


_PAIRS = f"SELECT k, substr(seq, 1, 40) AS r1, reverse(translate(substr(seq, 25), 'ACGTN', 'TGCAN')) AS r2 FROM ({D.REGIONS}) r"


@query(f"""WITH p AS ({_PAIRS}), b AS (SELECT k, r1, reverse(translate(r2, 'ACGTN', 'TGCAN')) AS b FROM p),
o AS (SELECT k, r1, b, list_max(list_filter(range(10, CAST(least(length(r1), length(b)) + 1 AS bigint)), lambda n: substr(r1, length(r1) - n + 1) = substr(b, 1, n))) AS overlap FROM b)
SELECT k, CAST(overlap AS int) AS overlap, concat(r1, substr(b, overlap + 1)) AS merged_ FROM o WHERE overlap IS NOT NULL""")
def read_merge(spark, sf_dir):
    m = trim.merge_pairs(D.view(spark, sf_dir, _PAIRS, "orders")).where("overlap IS NOT NULL")
    return m.select("k", "overlap", F.col("merged").alias("merged_"))


@query("SELECT coalesce(a.o_orderkey, b.l_orderkey) AS read_id, CASE WHEN b.l_orderkey IS NULL THEN 'only_1' WHEN a.o_orderkey IS NULL THEN 'only_2' ELSE 'pair' END AS side FROM (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 <> 0) a FULL JOIN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey % 5 <> 0) b ON a.o_orderkey = b.l_orderkey")
def read_repair(spark, sf_dir):
    a = _table(spark, sf_dir, "orders").where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("read_id"), F.lit("A").alias("seq"))
    b = _table(spark, sf_dir, "lineitem").where("l_orderkey % 5 <> 0").select(F.col("l_orderkey").alias("read_id"), F.lit("C").alias("seq")).distinct()
    return trim.repair(a, b).select("read_id", "side")


@query(f"WITH r AS ({D.REGIONS}) SELECT k, reverse(translate(upper(seq), 'ACGTMRWSYKVHDBN', 'TGCAKYWSRMBDHVN')) AS seq, reverse(substr(md5(seq), 1, 20)) AS qual FROM r")
def reverse_records(spark, sf_dir):
    r = D.regions(spark, sf_dir)
    return r.select("k", S.reverse_complement(F.upper("seq")).alias("seq"), S.reverse_quality(F.substring(F.md5("seq"), 1, 20)).alias("qual"))


@query(f"WITH {NNK} SELECT coalesce(reason, 'pass') AS reason, count(*) AS n FROM val2 GROUP BY 1")
def strategy_counts(spark, sf_dir):
    from quillon.plans.catalog import NNK_ROWS

    v = library.strategy("3xNNK", wildtype=WILDTYPE)(D.view(spark, sf_dir, NNK_ROWS, "part"))
    return v.groupBy(F.coalesce("reason", F.lit("pass")).alias("reason")).agg(F.count("*").alias("n"))

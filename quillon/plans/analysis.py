"""Queries of sequence sets: filters, overlaps, positions, properties."""

from pyspark.sql import functions as F

from quillon.functions import protein as P, seq as S
from quillon.operators import label, stats
from quillon.plans import derived as D
from quillon.plans.catalog import LABELS, POSITIONS, REFERENCE, WIDE, _COLS, _labels, _table, _wide
from quillon.plans.registry import query

#: Sequences with and without stop codons, ambiguous residues and the flanks of the library.
SEQUENCES = f"""SELECT p_partkey AS k, p_size, concat(CASE WHEN p_size % 3 = 0 THEN 'A' ELSE 'C' END, translate(substr(md5(p_name), 1, 9), {D.HEX}, 'ACDEFGHIKLMNPQ*X'), CASE WHEN p_size % 4 = 0 THEN 'Y' ELSE 'F' END) AS cdr3 FROM part"""


def _sequences(spark, sf_dir):
    return D.view(spark, sf_dir, SEQUENCES, "part")


@query(f"WITH q AS ({SEQUENCES}) SELECT k, cdr3 FROM q WHERE cdr3 NOT LIKE '%*%'")
def drop_stop_codons(spark, sf_dir):
    return _sequences(spark, sf_dir).where(~F.col("cdr3").contains("*")).select("k", "cdr3")


@query(f"WITH q AS ({SEQUENCES}) SELECT k, cdr3 FROM q WHERE cdr3 LIKE 'C%F'")
def flanking_residues(spark, sf_dir):
    return _sequences(spark, sf_dir).where(F.col("cdr3").startswith("C") & F.col("cdr3").endswith("F")).select("k", "cdr3")


@query(f"WITH q AS ({SEQUENCES}) SELECT k, cdr3 FROM q WHERE cdr3 NOT LIKE '%X%'")
def drop_ambiguous(spark, sf_dir):
    return _sequences(spark, sf_dir).where(~F.col("cdr3").contains("X")).select("k", "cdr3")


@query(f"WITH q AS ({SEQUENCES}) SELECT k, split_part(cdr3, '*', 1) AS aa FROM q")
def translate_to_stop(spark, sf_dir):
    return _sequences(spark, sf_dir).select("k", S.to_stop("cdr3").alias("aa"))


@query(f"WITH q AS ({SEQUENCES}) SELECT k, concat('C', cdr3, 'F') AS flanked FROM q")
def flanked_sequences(spark, sf_dir):
    return _sequences(spark, sf_dir).select("k", F.concat(F.lit("C"), "cdr3", F.lit("F")).alias("flanked"))


@query(f"WITH s AS ({D.SELECTION}) SELECT aa_seq, levenshtein(aa_seq, '{REFERENCE}') <= 9 AS near FROM s GROUP BY 1")
def edit_pattern_filter(spark, sf_dir):
    return D.selection(spark, sf_dir).select("aa_seq").distinct().select("aa_seq", stats.within_edits(REFERENCE, "aa_seq", 9).alias("near"))


#: The reference with a few letters changed, dropped or added in the middle.
EDITED = f"SELECT p_partkey AS k, concat(substr('{REFERENCE}', 1, p_size % 8), substr(translate(md5(p_name), {D.HEX}, 'ACDEFGHIKLMNPQRS'), 1, CAST(p_partkey % 4 AS int)), substr('{REFERENCE}', p_size % 8 + 1 + CAST(p_partkey % 3 AS int))) AS q FROM part"


@query()
def edit_pattern_tiled(spark, sf_dir):
    """All edits in a span of four letters; difflib's blocks have no SQL form, the tests hold it against difflib row by row."""
    return D.view(spark, sf_dir, EDITED, "part").withColumn("near", stats.within_edits(REFERENCE, "q", 4, tiled=True))


@query(f"WITH q AS ({SEQUENCES}) SELECT count(DISTINCT length(cdr3)) AS n_lengths, count(DISTINCT length(cdr3)) = 1 AS fixed FROM q")
def fixed_length_check(spark, sf_dir):
    return stats.sequence_length_check(_sequences(spark, sf_dir), "cdr3")


@query(f"WITH e AS ({EDITED}) SELECT k, q FROM e WHERE length(q) = 11")
def length_filter(spark, sf_dir):
    return D.view(spark, sf_dir, EDITED, "part").where(F.length("q") == 11)


@query("SELECT CASE WHEN p_brand = 'Brand#1' AND p_size = 1 THEN 'library' WHEN p_brand = 'Brand#1' THEN 'plasmid' END AS part_, count(*) AS n FROM part GROUP BY 1")
def wildtype_split(spark, sf_dir):
    p = _table(spark, sf_dir, "part")
    kind = F.when((F.col("p_brand") == "Brand#1") & (F.col("p_size") == 1), "library").when(F.col("p_brand") == "Brand#1", "plasmid")
    return p.groupBy(kind.alias("part_")).agg(F.count("*").alias("n"))


_ARMS = f"WITH s AS ({D.SELECTION}), a AS (SELECT aa_seq, count(*) AS n FROM s WHERE condition = 'pos3x' GROUP BY 1), b AS (SELECT aa_seq, count(*) AS n FROM s WHERE condition = 'neg' GROUP BY 1)"


def _arm(spark, sf_dir, condition):
    return D.selection(spark, sf_dir).where(F.col("condition") == condition).groupBy("aa_seq").agg(F.count("*").alias("n"))


@query(f"{_ARMS} SELECT aa_seq, a.n AS n_pos, b.n AS n_neg FROM a JOIN b USING (aa_seq)")
def shared_variants(spark, sf_dir):
    a, b = (_arm(spark, sf_dir, c).withColumnRenamed("n", f"n_{s}") for c, s in (("pos3x", "pos"), ("neg", "neg")))
    return a.join(b, "aa_seq")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IN (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING count(*) >= 32)")
def frequent_rows(spark, sf_dir):
    return stats.frequent(_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), "l_partkey", 32)


_EVENTS = "SELECT event_id, user_id, concat(event_type, cast(event_id % 3 AS varchar)) AS kind FROM events"


@query(f"WITH e AS ({_EVENTS}), f AS (SELECT * FROM e WHERE kind IN (SELECT kind FROM e GROUP BY 1 HAVING count(*) >= 60)) SELECT * FROM f QUALIFY kind IS DISTINCT FROM lag(kind) OVER (PARTITION BY user_id ORDER BY event_id)")
def consecutive_collapse_frequent(spark, sf_dir):
    e = _table(spark, sf_dir, "events").selectExpr("event_id", "user_id", "concat(event_type, cast(event_id % 3 AS string)) AS kind")
    return stats.consecutive_collapse(e, "event_id", "kind", ("user_id",), 60)


@query("SELECT event_id, event_type IS DISTINCT FROM lag(event_type) OVER w OR row_number() OVER w = 1 AS starts FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)")
def group_starts(spark, sf_dir):
    return stats.group_starts(_table(spark, sf_dir, "events"), "event_id", "event_type", ("user_id",)).select("event_id", "starts")


@query(f"WITH s AS ({D.SELECTION}), d AS (SELECT DISTINCT aa_seq FROM s) SELECT CAST(levenshtein(aa_seq, '{REFERENCE}') AS bigint) AS distance, count(*) AS n FROM d GROUP BY 1")
def distance_histogram(spark, sf_dir):
    return stats.distance_histogram(D.selection(spark, sf_dir), REFERENCE)


# --- labels ------------------------------------------------------------------------------------------


@query(f"WITH {LABELS} SELECT specificity, count(*) AS n, 100 * count(*) / sum(count(*)) OVER () AS percent FROM labels_ GROUP BY 1")
def label_shares(spark, sf_dir):
    return label.label_shares(_labels(spark, sf_dir))


#: Peptides without one of the arms drop out.
_GATED = f"sel0 AS ({D.SELECTION}), sel1 AS (SELECT * FROM sel0 WHERE NOT (peptide LIKE '%3' AND condition = 'pos1x')), whole AS (SELECT peptide FROM sel1 WHERE condition IN ('neg', 'pos3x', 'pos1x') GROUP BY 1 HAVING count(DISTINCT condition) = 3)"


@query(f"WITH {_GATED}, {LABELS.replace(f'sel AS ({D.SELECTION})', chr(32) + 'sel AS (SELECT * FROM sel1 WHERE condition = ' + repr('lib') + ' OR peptide IN (SELECT peptide FROM whole))').strip()} SELECT {_COLS}, specificity FROM labels_")
def gated_labels(spark, sf_dir):
    s = D.selection(spark, sf_dir).where("NOT (peptide LIKE '%3' AND condition = 'pos1x')")
    return label.label(label.wide_counts(label.gated(s))).select(*_COLS.split(", "), "specificity")


@query(f"WITH {LABELS} SELECT peptide, aa_seq, specificity, CASE WHEN peptide LIKE '%1' THEN freq_lib END AS freq_lib FROM labels_")
def label_union(spark, sf_dir):
    rows = _labels(spark, sf_dir).select("peptide", "aa_seq", "specificity", "freq_lib")
    return label.union_labels([rows.where("peptide LIKE '%1'"), rows.where("NOT peptide LIKE '%1'").drop("freq_lib")])


@query(f"""WITH {WIDE} SELECT peptide, aa_seq, round(log10(freq_pos3x + 1e-6), 9) AS log10_, round(ln(freq_pos3x + 1e-6), 9) AS ln_, CASE WHEN freq_pos3x > 0 AND freq_lib > 0 THEN round(log2(freq_pos3x / freq_lib), 9) ELSE 0 END AS clean FROM wide""")
def log_transforms(spark, sf_dir):
    w = _wide(spark, sf_dir)
    ratio = F.log2(F.try_divide("freq_pos3x", "freq_lib"))
    return w.select("peptide", "aa_seq", F.round(F.log10(F.col("freq_pos3x") + 1e-6), 9).alias("log10_"), F.round(F.ln(F.col("freq_pos3x") + 1e-6), 9).alias("ln_"), F.round(stats.finite(F.when(F.col("freq_pos3x") > 0, ratio)), 9).alias("clean"))


# --- properties ----------------------------------------------------------------------------------------

_n = lambda a: f"(length(s) - length(replace(s, '{a}', '')))"
_end = lambda col, shifted, plain: f"CASE {' '.join(f'WHEN {col} = {a!r} THEN {pk}' for a, pk in shifted.items())} ELSE {plain} END"
_GROUPS = [("1", _end("substr(s, 1, 1)", P.N_END, P.POSITIVE["N-end"]), 1), ("1", _end("substr(s, -1, 1)", P.C_END, P.NEGATIVE["C-end"]), -1)]
_GROUPS += [(_n(a), str(pk), sign) for table, sign in ((P.POSITIVE, 1), (P.NEGATIVE, -1)) for a, pk in table.items() if len(a) == 1]


@query(f"""WITH q AS ({SEQUENCES}), c AS (SELECT k, replace(cdr3, '*', '') AS s FROM q)
SELECT k, round(({' + '.join(f'{_n(a)} * {h}' for a, h in P.HYDROPATHY.items())}) / length(s), 6) AS gravy, round(({_n('F')} + {_n('W')} + {_n('Y')}) / length(s), 6) AS aromaticity,
    round({' + '.join(f'{sign} * {n} / (1 + pow(10.0::double, {sign} * (7.4 - {pk})))' for n, pk, sign in _GROUPS)}, 6) AS charge FROM c""")
def sequence_properties(spark, sf_dir):
    return _sequences(spark, sf_dir).select("k", *[F.round(f("cdr3"), 6).alias(n) for f, n in ((P.gravy, "gravy"), (P.aromaticity, "aromaticity"), (P.charge, "charge"))])


@query()
def isoelectric_points(spark, sf_dir):
    """The pH of no net charge, by halving; the tests hold it against the charge at that pH."""
    return _sequences(spark, sf_dir).select("k", "cdr3", F.round(P.isoelectric_point("cdr3"), 4).alias("pi"))


#: A few neighbours' weights, given as a parameter; the published table has 400.
WEIGHTS = {"AC": 44.94, "CD": 20.26, "DE": 1.0, "GA": -7.49, "PP": 20.26, "QQ": 20.26, "KL": 1.0, "LM": 1.0, "NP": -1.88}


@query(f"""WITH q AS ({SEQUENCES}), c AS (SELECT k, replace(cdr3, '*', '') AS s FROM q)
SELECT k, round(CASE WHEN length(s) > 1 THEN 10.0 * list_sum([CASE substr(s, CAST(i AS bigint), 2) {' '.join(f"WHEN '{p}' THEN {w}::double" for p, w in WEIGHTS.items())} ELSE 0.0::double END FOR i IN range(1, length(s))]) / length(s) ELSE 0 END, 6) AS instability FROM c""")
def instability_index(spark, sf_dir):
    return _sequences(spark, sf_dir).select("k", F.round(P.instability("cdr3", WEIGHTS), 6).alias("instability"))


# --- positions -----------------------------------------------------------------------------------------

_GRID = f"{POSITIONS}, grid AS (SELECT pos, unnest(string_split('{S.AMINO_LETTERS}', '')) AS aa FROM (SELECT unnest(range(0, 11)) AS pos)), dense AS (SELECT CAST(grid.pos AS int) AS pos, grid.aa, count(*) FILTER (specificity = 1) AS a, count(*) FILTER (specificity = 0) AS b FROM grid LEFT JOIN px ON grid.pos = px.pos AND grid.aa = px.aa GROUP BY 1, 2)"


@query(f"""WITH {_GRID}, o AS (SELECT pos, aa, ln(((a + 1) / sum(a + 1) OVER w) / ((b + 1) / sum(b + 1) OVER w)) AS log_odds FROM dense WINDOW w AS (PARTITION BY pos))
SELECT CAST(t - 1 AS bigint) AS tile, pos, CAST(pos - t + 1 AS bigint) AS place, aa, round(log_odds, 9) AS log_odds FROM o, range(1, 8) r(t) WHERE pos BETWEEN t AND t + 3""")
def tile_log_odds(spark, sf_dir):
    return stats.tile_log_odds(_labels(spark, sf_dir), S.AMINO_LETTERS, 11).withColumn("log_odds", F.round("log_odds", 9))


@query(f"WITH {_GRID}, g AS (SELECT pos, aa, round(ln((a + 0.0001::double) / (b + 0.0001::double)), 9) AS log_ratio FROM dense) SELECT pos, aa, log_ratio FROM g QUALIFY row_number() OVER (PARTITION BY pos ORDER BY log_ratio DESC, instr('{S.AMINO_LETTERS}', aa)) = 1")
def top_anchor_residue_fine(spark, sf_dir):
    return stats.top_residue(_labels(spark, sf_dir), S.AMINO_LETTERS, pseudo=0.0001)


_AROUND = f"{POSITIONS}, g AS (SELECT CAST(pos AS int) AS pos, aa, count(*) AS n FROM px WHERE substr(aa_seq, 6, 1) = 'K' AND specificity = 1 GROUP BY 1, 2), h AS (SELECT *, n / sum(n) OVER (PARTITION BY pos) AS share, sum(n) OVER (PARTITION BY pos) AS cover FROM g)"


@query(f"WITH {_AROUND} SELECT pos, aa, n, share FROM h WHERE abs(pos - 5) BETWEEN 1 AND 3 AND cover >= 3 QUALIFY row_number() OVER (PARTITION BY pos ORDER BY n DESC, aa) = 1")
def anchor_cooccurrence_top(spark, sf_dir):
    return stats.cooccurrence(_labels(spark, sf_dir).where("specificity = 1"), 5, "K", least=3, top_only=True)


@query(f"WITH {_AROUND} SELECT pos, aa, n, share FROM h WHERE pos - 5 BETWEEN 1 AND 4")
def anchor_cooccurrence_following(spark, sf_dir):
    return stats.cooccurrence(_labels(spark, sf_dir).where("specificity = 1"), 5, "K", reach=4, following=True)


@query(f"WITH {POSITIONS} SELECT aa, count(*) AS n, CAST(min(pos) AS int) AS first_pos FROM px WHERE specificity = 1 GROUP BY 1 ORDER BY n DESC, aa LIMIT 1")
def commonest_residue(spark, sf_dir):
    return stats.commonest_residue(_labels(spark, sf_dir).where("specificity = 1"))


@query(f"""WITH {LABELS}, m AS (SELECT CAST((a - 1) // 4 AS bigint) AS tile, CAST(a - 1 AS int) AS start, CAST(b - a - 1 AS int) AS gap, substr(aa_seq, a, 1) AS a, substr(aa_seq, b, 1) AS b, count(*) AS n
    FROM labels_, range(1, 12) t(a), range(1, 12) u(b) WHERE b - a BETWEEN 1 AND 3 AND (a - 1) // 4 = (b - 1) // 4 GROUP BY ALL)
SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY tile ORDER BY n DESC, start, gap, a, b) <= 15""")
def top_motifs_per_tile(spark, sf_dir):
    m = stats.gapped_motifs(_labels(spark, sf_dir))
    return stats.top_per_group(m, "tile", [F.desc("n"), "start", "gap", "a", "b"], 15)

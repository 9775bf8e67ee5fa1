"""Counts per condition, enrichment and three-way specificity labels."""

from pyspark.sql import Window, functions as F

CONDITIONS = ("lib", "neg", "pos3x", "pos1x")
PSEUDOCOUNT = 1e-9
#: 1: a positive arm is enriched and the negative arm is not; 0: the other way round; 2: neither.
SPECIFICITY = """
    CASE WHEN (pos_vs_neg_status = 'Enriched' OR pos_vs_lib_status = 'Enriched') AND neg_vs_lib_status <> 'Enriched' THEN 1
         WHEN pos_vs_neg_status <> 'Enriched' AND pos_vs_lib_status <> 'Enriched' AND neg_vs_lib_status = 'Enriched' THEN 0
         ELSE 2 END"""


def wide_counts(selection, conditions=CONDITIONS, shared="lib"):
    """peptide, aa_seq, count_c and freq_c for each condition, in one scan.

    Conditional aggregation stands for the outer joins. The shared condition is counted over all
    peptides once and attached to each peptide that lists the variant or not.
    """
    own = [c for c in conditions if c != shared]
    s = selection.where(F.col("aa_seq").isNotNull())
    per = s.where(F.col("condition").isin(*own)).groupBy("peptide", "aa_seq").agg(*[F.count_if(F.col("condition") == c).alias(f"count_{c}") for c in own])
    lib = s.where(F.col("condition") == shared).groupBy("aa_seq").agg(F.count("*").alias(f"count_{shared}"))
    names = per.select("peptide").distinct()
    every = names.join(lib, how="cross").select("peptide", "aa_seq", f"count_{shared}", *[F.lit(0).cast("long").alias(f"count_{c}") for c in own])
    both = per.select("peptide", "aa_seq", F.lit(0).cast("long").alias(f"count_{shared}"), *[f"count_{c}" for c in own]).unionByName(every)
    w = both.groupBy("peptide", "aa_seq").agg(*[F.sum(f"count_{c}").alias(f"count_{c}") for c in conditions])
    total = Window.partitionBy("peptide")
    for c in conditions:
        t = F.sum(f"count_{c}").over(total)
        w = w.withColumn(f"freq_{c}", F.when(t > 0, F.col(f"count_{c}") / t).otherwise(0.0))
    return w


def ratio(w, num, den, name=None, eps=PSEUDOCOUNT):
    return w.withColumn(name or f"enrich_{num}_vs_{den}", F.try_divide(F.col(f"freq_{num}") + eps, F.col(f"freq_{den}") + eps))


def flag(c, up=2.0, down=0.5):
    return F.when(F.col(c) >= up, "Enriched").when(F.col(c) <= down, "Depleted").otherwise("NoChange")


def combine(a, b):
    return F.when((F.col(a) == "Enriched") | (F.col(b) == "Enriched"), "Enriched").when((F.col(a) == "Depleted") & (F.col(b) == "Depleted"), "Depleted").otherwise("NoChange")


def label(w, positives=("pos3x", "pos1x"), eps=PSEUDOCOUNT):
    """Adds ratios, statuses and specificity: 1 binder, 0 non-binder, 2 undecided."""
    missing = {f"freq_{c}" for c in ("lib", "neg", *positives)} - set(w.columns)
    if missing:
        raise ValueError(f"missing columns: {sorted(missing)}")
    for den in ("neg", "lib"):
        for p in positives:
            w = ratio(w, p, den, eps=eps)
    w = ratio(w, "neg", "lib", "deplete_neg_lib", eps)
    for den in ("neg", "lib"):
        for p in positives:
            w = w.withColumn(f"{p}_vs_{den}_status", flag(f"enrich_{p}_vs_{den}"))
        names = [f"{p}_vs_{den}_status" for p in positives]
        if tuple(positives) != ("pos",):
            w = w.withColumn(f"pos_vs_{den}_status", combine(*names) if len(names) > 1 else F.col(names[0]))
    w = w.withColumn("neg_vs_lib_status", flag("deplete_neg_lib"))
    return w.withColumn("specificity", F.expr(SPECIFICITY))


def gated(selection, conditions=("neg", "pos3x", "pos1x"), shared="lib"):
    """The rows of peptides that have every required condition, and of the shared one."""
    complete = complete_peptides(selection.where(F.col("condition") != shared), conditions).where("complete").select("peptide")
    own = selection.join(complete, "peptide", "left_semi").where(F.col("condition") != shared)
    return own.unionByName(selection.where(F.col("condition") == shared))

def parse_condition(name, prefix="clib", suffixes=(("originallib", "lib"), ("2xnegative", "neg"), ("31xpositive", "pos1x"), ("3xpositive", "pos3x")), exact_lib=False):
    """peptide and condition of a sample name; both null when no suffix fits. A name that is all suffix is the shared one.

    With exact_lib the shared condition's suffix must be the whole name.
    """
    token = F.regexp_replace(name, f"^{prefix}", "")
    peptide, condition = F, F
    for suffix, what in suffixes:
        hit = token == suffix if what == "lib" and exact_lib else token.endswith(suffix)
        rest = F.regexp_replace(F.regexp_replace(token, f"{suffix}$", ""), "[-_]+$", "")
        peptide, condition = peptide.when(hit, F.when(rest == "", "lib" if what == "lib" else "peptide").otherwise(rest)), condition.when(hit, F.lit(what))
    none = F.lit(None).cast("string")
    return peptide.otherwise(none), condition.otherwise(none)


def label_summary(labels):
    return labels.groupBy("peptide").agg(F.count("*").alias("n_variants"), *[F.count_if(F.col("specificity") == s).alias(f"n_spec_{s}") for s in (1, 0, 2)])


def complete_peptides(selection, conditions=("neg", "pos3x", "pos1x")):
    """peptide and whether it has every required condition."""
    g = selection.groupBy("peptide").agg(F.collect_set("condition").alias("has"))
    return g.select("peptide", (F.size(F.array_except(F.array(*[F.lit(c) for c in conditions]), "has")) == 0).alias("complete"))


def last_by_name(mapping, order=None):
    """One row a name of mapping (name, sequence): the last one, by the column order or else by place in the table."""
    place = F.monotonically_increasing_id() if order is None else F.col(order)
    return mapping.select("name", "sequence", place.alias("at")).groupBy("name").agg(F.max_by("sequence", "at").alias("sequence"))


def ml_rows(labels, mapping=None, order=None):
    """tcr, peptide, label of the confident rows; peptide names are looked up in mapping (name, sequence), where the last of a name counts."""
    rows = labels.where(F.col("specificity").isin(0, 1)).select(F.col("aa_seq").alias("tcr"), "peptide", F.col("specificity").alias("label"))
    if mapping is None:
        return rows
    one = last_by_name(mapping, order)
    return rows.join(one, rows.peptide == one.name, "left").select("tcr", F.col("sequence").alias("peptide"), "label")


def output_name(peptide):
    """A peptide's name as part of a file name."""
    return F.coalesce(F.nullif(F.trim(F.regexp_replace(peptide, "[^A-Za-z0-9._-]+", "_"), F.lit("_")), F.lit("")), F.lit("peptide"))


def union_labels(tables):
    """All rows of label tables in one; columns that a table lacks are null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def label_shares(labels):
    """specificity, n, and percent of all rows."""
    g = labels.groupBy("specificity").agg(F.count("*").alias("n"))
    total = g.agg(F.sum("n").alias("total"))
    return g.join(F.broadcast(total)).select("specificity", "n", (100 * F.col("n") / F.col("total")).alias("percent"))

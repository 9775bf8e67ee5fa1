"""Molecular-barcode operators: extraction, consensus calling, rescue."""

from pyspark.sql import Window, functions as F

from quillon.functions import search, seq as S


def extract(reads, anchor, umi_length=12, spacer=(0, 3), edits=0):
    """Adds drop_reason, umi, insert, insert_qual. Layout: spacer, barcode, anchor, insert.

    The anchor is the leftmost one that starts where the spacer lets it; reads that hold it
    elsewhere only are told from those without one. With `edits` it may differ by so many.
    """
    low, high = umi_length + spacer[0], umi_length + spacer[1]
    if edits:
        r = reads.withColumn("hit", search.edit_anchor("seq", anchor, edits, low, high))
        r = r.withColumn("at", F.when(F.col("hit.start") >= 0, F.col("hit.start"))).withColumn("end", F.col("hit.end")).withColumn("any", F.col("hit.any")).drop("hit")
    else:
        first = F.locate(anchor, F.col("seq"), low + 1) - 1
        r = reads.withColumn("at", F.when(first.between(low, high), first)).withColumn("end", F.col("at") + len(anchor)).withColumn("any", F.instr("seq", anchor) > 0)
    reason = (
        F.when(F.length("seq") < spacer[1] + umi_length + len(anchor), "too_short")
        .when(F.col("at").isNull() & ~F.col("any"), "no_anchor")
        .when(F.col("at").isNull(), "anchor_wrong_pos")
        .when(F.length("seq") <= F.col("end"), "empty_insert")
    )
    r = r.withColumn("drop_reason", reason)
    ok = F.col("drop_reason").isNull()
    return (
        r.withColumn("umi", F.when(ok, F.expr(f"substr(seq, at + 1 - {umi_length}, {umi_length})")))
        .withColumn("insert", F.when(ok, F.expr("substr(seq, end + 1)")))
        .withColumn("insert_qual", F.when(ok, F.expr("substr(qual, end + 1)")))
        .drop("at", "end", "any")
    )


def extract_legacy(reads, anchor, umi_length=12, edits=0):
    """Adds umi (the first bases) and insert (the anchor on), where the anchor comes anywhere behind the barcode; else null."""
    behind = F.expr(f"substr(seq, {umi_length + 1})")
    if edits:
        at = F.nullif(search.edit_first(behind, anchor, edits) + 1, F.lit(0))
    else:
        at = F.nullif(F.instr(behind, anchor), F.lit(0))
    r = reads.withColumn("at", at)
    return r.withColumn("umi", F.when(F.col("at").isNotNull(), F.substring("seq", 1, umi_length))).withColumn("insert", F.expr(f"substr(seq, {umi_length} + at)")).drop("at")


def classes(umis, least=2):
    """umi, n_reads and its class: consensus, singleton or other."""
    kind = F.when(F.col("n_reads") >= least, "consensus").when(F.col("n_reads") == 1, "singleton").otherwise("other")
    return umis.groupBy("umi").agg(F.count("*").alias("n_reads")).withColumn("kind", kind)


def of_size(umis, least, most=None):
    """The reads of barcodes with at least, and at most, so many of them, with n_reads."""
    n = F.count("*").over(Window.partitionBy("umi"))
    kept = umis.withColumn("n_reads", n).where(F.col("n_reads") >= least)
    return kept if most is None else kept.where(F.col("n_reads") <= most)


def singletons(umis):
    """Reads that are their barcode's only one, as records: read_id, seq, qual."""
    return of_size(umis, 1, 1).select(F.concat("umi", F.lit("|n=1")).alias("read_id"), F.col("insert").alias("seq"), F.col("insert_qual").alias("qual"))


def umi_of(read_id):
    """The barcode in a record's name."""
    return F.substring_index(read_id, "|n=", 1)


def anchored_variant(seq, anchor, length):
    """The bases behind the leftmost anchor; null without one or with too few bases behind it."""
    s = S.col(seq)
    at = F.instr(s, anchor)
    return F.when((at > 0) & (F.length(s) >= at + len(anchor) - 1 + length), F.substr(s, at + len(anchor), F.lit(length)))


def anchored_reason(seq, anchor, length):
    """Why a read has no variant; null where it has one."""
    return F.when(F.instr(S.col(seq), anchor) == 0, "no_anchor").when(anchored_variant(seq, anchor, length).isNull(), "too_short_after_anchor")


def consensus_records(called, n_reads="n_reads"):
    """Consensus as records: read_id, seq, and one placeholder quality a base."""
    return called.select(F.concat_ws("|n=", "umi", F.col(n_reads).cast("string")).alias("read_id"), F.col("cons_seq").alias("seq"), F.repeat(F.lit("I"), F.length("cons_seq")).alias("qual"))


def extraction_inputs(consensus=None, rescued=None):
    """Consensus and rescued records in one table, with their source; one of them may be missing."""
    parts = [df.withColumn("source", F.lit(name)) for name, df in (("consensus", consensus), ("singleton", rescued)) if df is not None]
    if not parts:
        raise ValueError("neither consensus nor rescued records are given")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def posterior_columns(umis, min_delta=2.0, digits=6):
    """umi, pos (0-based), call, log_delta, and n_reads where umis have it. One hash aggregation; N where the lead is below min_delta."""
    keep = ["n_reads"] if "n_reads" in umis.columns else []
    bases = umis.select("umi", *keep, F.posexplode(F.split("insert", "")).alias("pos", "base"), "insert_qual")
    bases = bases.withColumn("q", F.coalesce(F.ascii(F.expr("nullif(substr(insert_qual, pos + 1, 1), '')")) - 33, F.lit(0)))
    # one weight per quality, computed once: the exploded rows only look it up
    w = F.get(F.array(*[F.lit(S.vote_weight_of(q)) for q in range(94)]), F.col("q"))
    votes = bases.groupBy("umi", *keep, "pos").agg(*[F.coalesce(F.round(F.sum(F.when(F.col("base") == b, w)), digits), F.lit(0.0)).alias(b) for b in "ACGT"], F.count_if(F.col("base").isin(*"ACGT")).alias("n"))
    ranked = F.sort_array(F.array(*[F.col(b) for b in "ACGT"]), False)
    delta = F.when(F.col("n") == 0, 0.0).otherwise(F.round(ranked[0] - ranked[1], 6))
    best = F.when(F.col("A") == ranked[0], "A").when(F.col("C") == ranked[0], "C").when(F.col("G") == ranked[0], "G").otherwise("T")
    votes = votes.withColumn("log_delta", delta)
    return votes.select("umi", *keep, "pos", F.when((F.col("n") == 0) | (F.col("log_delta") < min_delta), "N").otherwise(best).alias("call"), "log_delta")


def consensus(columns):
    """umi, cons_seq and QC from posterior_columns; p10 is sorted[int(0.1 * (n - 1))].

    Where columns have n_reads, the reads of the barcode, it is passed on.
    """
    keep = ["n_reads"] if "n_reads" in columns.columns else []
    g = columns.groupBy("umi", *keep).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "call"))), lambda x: x["call"]), "").alias("cons_seq"), F.sort_array(F.collect_list("log_delta")).alias("d"))
    n = F.size("d")
    return g.select(
        "umi",
        *keep,
        "cons_seq",
        n.cast("long").alias("cons_len"),
        (F.length("cons_seq") - F.length(F.replace(F.col("cons_seq"), F.lit("N"), F.lit("")))).cast("long").alias("n_n"),
        F.round(F.col("d")[0], 3).alias("min_log_delta"),
        F.round((F.element_at("d", F.expr("(size(d) + 1) div 2").cast("int")) + F.element_at("d", F.expr("size(d) div 2 + 1").cast("int"))) / 2, 3).alias("median_log_delta"),
        F.round(F.element_at("d", F.expr("(size(d) - 1) div 10 + 1").cast("int")), 3).alias("p10_log_delta"),
    )


def majority(umis, order="read_no"):
    """umi, pos, call by most votes; ties go to the base seen first, then to the first letter, so that reruns agree."""
    bases = umis.select("umi", order, F.posexplode(F.split("insert", "")).alias("pos", "base"))
    votes = bases.groupBy("umi", "pos", "base").agg(F.count("*").alias("n"), F.min(order).alias("seen"))
    return votes.groupBy("umi", "pos").agg(F.min_by("base", F.struct(-F.col("n"), "seen", "base")).alias("call"))


def divergence(umis, consensus):
    """umi, mean mismatches of its reads to its consensus; reads of another length are left out, 0 without any."""
    h = F.when(F.length("insert") == F.length("cons_seq"), S.hamming("insert", "cons_seq"))
    return umis.join(consensus.select("umi", "cons_seq"), "umi").groupBy("umi").agg(F.coalesce(F.avg(h), F.lit(0.0)).alias("divergence"))


def soft_grid(umis, grid, least_reads=2):
    """top_k, least, umi, insert, n, rank for each (top_k, least) of a small grid, in one pass.

    Barcodes with fewer than least_reads reads take no part. Dropping rare sequences leaves the
    order of the others as it is, so one ranking serves the whole grid.
    """
    counts = umis.groupBy("umi", "insert").agg(F.count("*").alias("n"))
    c = counts.withColumn("total", F.sum("n").over(Window.partitionBy("umi"))).where(F.col("total") >= least_reads)
    c = c.withColumn("rank", F.row_number().over(Window.partitionBy("umi").orderBy(F.desc("n"), "insert")).cast("long"))
    pairs = F.array(*[F.struct(F.lit(k).alias("top_k"), F.lit(m).alias("least")) for k, m in grid])
    return c.select("umi", "insert", "n", "rank", F.explode(F.filter(pairs, lambda p: (F.col("n") >= p["least"]) & (F.col("rank") <= p["top_k"]))).alias("p")).select("p.*", "umi", "insert", "n", "rank")


def soft(umis, top_k=3, fraction=0.9, least=1):
    """umi, insert, n, rank: each barcode's leading sequences until the fraction is reached or k are kept; 0 disables either."""
    counts = umis.groupBy("umi", "insert").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    order = Window.partitionBy("umi").orderBy(F.desc("n"), "insert")
    c = counts.withColumn("rank", F.row_number().over(order).cast("long")).withColumn("total", F.sum("n").over(Window.partitionBy("umi")))
    c = c.withColumn("before", F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    keep = F.lit(True)
    if fraction:
        keep = keep & (F.col("before") / F.col("total") < fraction)
    if top_k:
        keep = keep & (F.col("rank") <= top_k)
    return c.where(keep).select("umi", "insert", "n", "rank")


def rescue(singles, least=2):
    """variant, n_umis of variants that enough distinct barcodes carry."""
    return singles.groupBy("variant").agg(F.count_distinct("umi").alias("n_umis")).where(F.col("n_umis") >= least)


def rescued_reads(singles, least=2):
    """The reads of rescued variants."""
    return singles.join(rescue(singles, least), "variant", "left_semi")

"""Library operators: region extraction and design validation."""

from pyspark.sql import Window, functions as F

from quillon.functions import search, seq as S


def extract_region(reads, anchor, size=33, mismatches=0, drop_n=True):
    """Adds fail_reason, region (reverse complement of the bases behind the rightmost anchor hit) and aa."""
    at = S.last_find(F.upper("seq"), anchor) if not mismatches else search.last_substitution_hit(F.upper("seq"), anchor, mismatches)
    r = reads.withColumn("at", at).withColumn("raw", F.expr(f"substr(upper(seq), at + {len(anchor)}, {size})"))
    reason = F.when(F.col("at") == 0, "anchor_not_found").when(F.length("raw") < size, "region_too_short")
    if drop_n:
        reason = reason.when(F.col("raw").contains("N"), "contains_N")
    r = r.withColumn("fail_reason", reason).withColumn("region", F.when(F.col("fail_reason").isNull(), S.reverse_complement("raw")))
    return r.withColumn("aa", S.translate_region("region")).drop("at", "raw")


STOPS = ("TAA", "TAG", "TGA")


def _codon(region, i):
    return F.substr(F.col(region), 3 * i - 2, F.lit(3))


def _allowed(pattern):
    """The codons of a degenerate pattern, parted by commas."""
    found = [""]
    for base in pattern:
        found = [c + b for c in found for b in S.IUPAC_BASES[base]]
    return ",".join(found)


def validate_combinatorial(rows, patterns, region="region"):
    """reason and fail_pos (1-based) of the first codon that is a stop or off its degenerate pattern."""
    allowed = F.array(*[F.lit(_allowed(p)) for p in patterns])
    off = lambda i: _codon(region, i).isin(*STOPS) | (F.instr(F.get(allowed, i - 1), _codon(region, i)) == 0)
    first = F.try_element_at(F.filter(F.sequence(F.lit(1), F.lit(len(patterns))), off), F.lit(1))
    r = rows.withColumn("fail_pos", F.when(F.col(region).isNotNull(), first).cast("long"))
    stop = _codon(region, F.col("fail_pos").cast("int")).isin(*STOPS)
    return r.withColumn("reason", F.when(F.col("fail_pos").isNotNull(), F.when(stop, "stop_codon").otherwise("degenerate_mismatch")))


def validate_nnk(rows, wildtype, most=3, region="region"):
    """reason and mutated codon positions against the wild type: too many, then in order stop or not NNK."""
    changed = F.filter(F.sequence(F.lit(1), F.lit(len(wildtype) // 3)), lambda i: _codon(region, i) != F.substr(F.lit(wildtype), 3 * i - 2, F.lit(3)))
    r = rows.withColumn("mutated", changed)
    bad = F.try_element_at(F.filter("mutated", lambda i: _codon(region, i).isin(*STOPS) | ~_codon(region, i).rlike(f"^{S.degenerate_regex('NNK')}$")), F.lit(1))
    why = F.when(_codon(region, bad).isin(*STOPS), "stop_codon").otherwise("mutation_not_NNK")
    return r.withColumn("reason", F.when(F.size("mutated") > most, "too_many_mutations").when(bad.isNotNull(), why))


def strategy(kind, patterns=None, wildtype=None, codons=11, most=3):
    """The validation of a design by name: combinatorial (one pattern a codon) or 3xNNK (a wild type); raises where the design does not fit."""
    if kind == "combinatorial":
        if not patterns or len(patterns) != codons or any(len(p) != 3 for p in patterns):
            raise ValueError(f"{codons} codon patterns are needed")
        return lambda rows: validate_combinatorial(rows, patterns)
    if kind == "3xNNK":
        if not wildtype or len(wildtype) != 3 * codons:
            raise ValueError(f"the wild type needs {3 * codons} bases")
        return lambda rows: validate_nnk(rows, wildtype, most)
    raise ValueError(f"no such design: {kind}")


def extract_between(rows, start, end, edits=0, substitutions=0, seq="seq"):
    """Adds from_, to_ (0-based places of both anchors, -1 if missing) and between, the bases from one to the other.

    between is null unless the second anchor begins behind the first one's start.
    """
    if edits:
        a, b = search.edit_first(seq, start, edits), search.edit_first(seq, end, edits)
    elif substitutions:
        a, b = search.substitution_hit(seq, start, substitutions) - 1, search.substitution_hit(seq, end, substitutions) - 1
    else:
        a, b = F.instr(seq, start) - 1, F.instr(seq, end) - 1
    r = rows.withColumn("from_", a).withColumn("to_", b)
    inside = F.substr(F.col(seq), F.col("from_") + len(start) + 1, F.greatest(F.col("to_") - F.col("from_") - len(start), F.lit(0)))
    return r.withColumn("between", F.when((F.col("from_") >= 0) & (F.col("from_") < F.col("to_")), inside))


def extract_codons(rows, start, end, codons, edits=0, seq="seq"):
    """extract_between with a reason, nt_seq (the first codons) and aa_seq: no anchor, end before start, too short."""
    r = extract_between(rows, start, end, edits, seq=seq)
    first = F.col("from_") + len(start)
    reason = (
        F.when((F.col("from_") < 0) | (F.col("to_") < 0), "no_anchor")
        .when(F.col("to_") <= first, "end_before_start")
        .when(F.length("between") == 0, "empty_region")
        .when(F.length("between") < 3 * codons, "region_too_short")
    )
    r = r.withColumn("reason", reason).withColumn("nt_seq", F.when(F.col("reason").isNull(), F.substring("between", 1, 3 * codons)))
    return r.withColumn("aa_seq", F.when(F.col("reason").isNull(), S.translate_region("nt_seq")))


def extraction_stats(extracted):
    """what (start, end or length of the region), n, and its least, upper median (place n div 2 of the sorted) and greatest value."""
    length = F.when((F.col("from_") >= 0) & (F.col("to_") > F.col("from_")), F.nullif(F.length("between"), F.lit(0)))
    r = extracted.select(*[F.when(F.col(c) >= 0, F.col(c)).cast("long").alias(n) for c, n in (("from_", "start"), ("to_", "end"))], length.cast("long").alias("length"))
    g = r.unpivot([], ["start", "end", "length"], "what", "value").where("value is not null").groupBy("what", "value").agg(F.count("*").alias("c"))
    # one row a distinct place
    g = g.withColumn("upto", F.sum("c").over(Window.partitionBy("what").orderBy("value"))).withColumn("n", F.sum("c").over(Window.partitionBy("what")))
    median = F.min(F.when(F.col("upto") > F.floor(F.col("n") / 2), F.col("value")))
    return g.groupBy("what").agg(F.max("n").alias("n"), F.min("value").alias("least"), median.alias("median"), F.max("value").alias("most"))


def variant_counts(extracted, wildtype, least=2, region="between"):
    """aa, n, distance: reads of each translation up to its first stop, from regions seen `least` times, as long as the wild type's.

    Regions of another length than the wild type's, or equal to it, are left out.
    """
    r = extracted.where((F.length(region) == len(wildtype)) & (F.col(region) != wildtype))
    g = r.groupBy(F.col(region).alias("nt")).agg(F.count("*").alias("n")).where(F.col("n") >= least)
    g = g.withColumn("aa", S.to_stop(S.translate_region("nt"))).groupBy("aa").agg(F.sum("n").alias("n"))
    wt = S.to_stop(S.translate_region(F.lit(wildtype)))
    return g.where(F.length("aa") == F.length(wt)).withColumn("distance", F.levenshtein("aa", wt))

"""Column functions on nucleotide and protein strings. Positions are 1-based unless said otherwise."""

import math

from pyspark.sql import Column, functions as F

#: IUPAC codes with their complements, and the standard codon table in TCAG order.
IUPAC = "ACGTMRWSYKVHDBN"
COMPLEMENT = "TGCAKYWSRMBDHVN"
IUPAC_BASES = {"A": "A", "C": "C", "G": "G", "T": "T", "M": "AC", "R": "AG", "W": "AT", "S": "CG", "Y": "CT", "K": "GT", "V": "ACG", "H": "ACT", "D": "AGT", "B": "CGT", "N": "ACGT"}
BASES = "TCAG"
AMINO = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
AMINO_LETTERS = "ACDEFGHIKLMNPQRSTVWY"


def col(c):
    return F.col(c) if isinstance(c, str) else c


def reverse_complement(seq) -> Column:
    return F.reverse(F.translate(col(seq), IUPAC, COMPLEMENT))


def codon_at(seq, i) -> Column:
    """Amino acid of codon i (0-based); X where a base is not A, C, G or T."""
    codon = F.substr(col(seq), i * 3 + 1, F.lit(3))
    base = lambda k: F.instr(F.lit(BASES), F.substr(codon, F.lit(k), F.lit(1))) - 1
    index = 16 * base(1) + 4 * base(2) + base(3)
    return F.when(codon.rlike("^[ACGT]{3}$"), F.substr(F.lit(AMINO), index + 1, F.lit(1))).otherwise("X")


def translate_region(seq) -> Column:
    """Amino acids of the whole codons of a sequence."""
    n = F.floor(F.length(col(seq)) / 3).cast("int")
    return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: codon_at(seq, i)), "")).otherwise("")


def to_stop(aa) -> Column:
    return F.substring_index(col(aa), "*", 1)


def degenerate_regex(pattern: str) -> str:
    """Regular expression of an IUPAC pattern."""
    return "".join(f"[{IUPAC_BASES[b]}]" for b in pattern)


def last_find(seq, literal: str) -> Column:
    """1-based start of the last exact occurrence, 0 if none."""
    s = col(seq)
    at = F.instr(F.reverse(s), F.lit(literal[::-1]))
    return F.when(at > 0, F.length(s) - at - len(literal) + 2).otherwise(0)


def hamming(a, b) -> Column:
    """Mismatches over the shorter of both."""
    n = F.least(F.length(col(a)), F.length(col(b)))
    return F.when(n > 0, F.size(F.filter(F.sequence(F.lit(1), n), lambda i: F.substr(col(a), i, F.lit(1)) != F.substr(col(b), i, F.lit(1))))).otherwise(0)


def phred(qual) -> Column:
    """Quality string (phred + 33) as numbers."""
    return F.transform(F.split(col(qual), ""), lambda x: F.ascii(x) - 33)


def quality_string(q) -> Column:
    return F.array_join(F.transform(col(q), lambda x: F.chr(F.least(F.greatest(x, F.lit(0)), F.lit(93)) + 33)), "")


def error_probability(q) -> Column:
    return F.least(F.greatest(F.pow(F.lit(10.0), -col(q) / 10.0), F.lit(1e-12)), F.lit(1 - 1e-12))


def vote_weight(q) -> Column:
    """ln(1 - p) - ln(p / 3): what a base of quality q adds to its own letter."""
    p = error_probability(q)
    return F.ln(1 - p) - F.ln(p / 3)


def vote_weight_of(q: int) -> float:
    """vote_weight of one quality, as a number."""
    p = min(max(10.0 ** (-q / 10.0), 1e-12), 1 - 1e-12)
    return math.log(1 - p) - math.log(p / 3)


def reverse_quality(qual) -> Column:
    """Qualities in the order of the reverse complement."""
    return F.reverse(col(qual))


def sanitize(token, default="unknown") -> Column:
    """A token of letters, digits, points, dashes and underscores, for file names."""
    kept = F.trim(F.regexp_replace(F.trim(col(token)), "[^A-Za-z0-9._-]+", "_"), F.lit("_"))
    return F.coalesce(F.nullif(kept, F.lit("")), F.lit(default))


def trimmed_name(file) -> Column:
    """The file name of a trimmed FASTQ."""
    f = col(file)
    return (
        F.when(f.endswith(".fastq.gz"), F.replace(f, F.lit(".fastq.gz"), F.lit(".trimmed.fastq.gz")))
        .when(f.endswith(".fq.gz"), F.replace(f, F.lit(".fq.gz"), F.lit(".trimmed.fq.gz")))
        .otherwise(F.concat(f, F.lit(".trimmed.fastq.gz")))
    )


def safe_name(name) -> Column:
    return F.regexp_replace(F.trim(col(name)), "[ /]", "_")

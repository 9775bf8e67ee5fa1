"""Physicochemical properties of protein sequences, as column functions."""

from pyspark.sql import functions as F

from quillon.functions.seq import col

#: Kyte-Doolittle hydropathy.
HYDROPATHY = {"A": 1.8, "R": -4.5, "N": -3.5, "D": -3.5, "C": 2.5, "Q": -3.5, "E": -3.5, "G": -0.4, "H": -3.2, "I": 4.5, "L": 3.8, "K": -3.9, "M": 1.9, "F": 2.8, "P": -1.6, "S": -0.8, "T": -0.7, "W": -0.9, "Y": -1.3, "V": 4.2}
#: pK of charged groups (Bjellqvist and others), and of the ends where the residue there shifts them.
POSITIVE = {"N-end": 7.5, "K": 10.0, "R": 12.0, "H": 5.98}
NEGATIVE = {"C-end": 3.55, "D": 4.05, "E": 4.45, "C": 9.0, "Y": 10.0}
N_END = {"A": 7.59, "M": 7.0, "S": 6.93, "P": 8.36, "T": 6.82, "V": 7.44, "E": 7.7}
C_END = {"D": 4.55, "E": 4.75}


def clean(seq):
    """The sequence without stop codons."""
    return F.replace(col(seq), F.lit("*"), F.lit(""))


def _number(seq, letter):
    return F.length(seq) - F.length(F.replace(seq, F.lit(letter), F.lit("")))


def gravy(seq):
    """Mean hydropathy; null for the empty sequence."""
    s = clean(seq)
    total = F.lit(0.0)
    for a, h in HYDROPATHY.items():
        total = total + _number(s, a) * F.lit(h)
    return F.try_divide(total, F.length(s))


def aromaticity(seq):
    """Share of F, W and Y."""
    s = clean(seq)
    return F.try_divide((_number(s, "F") + _number(s, "W") + _number(s, "Y")).cast("double"), F.length(s))


def _groups(seq):
    """(number, pK, sign) of each charged group."""
    s = clean(seq)

    def end(letter, shifted, plain):
        out = F
        for a, pk in shifted.items():
            out = out.when(letter == a, F.lit(pk))
        return out.otherwise(F.lit(plain))

    first, last = F.substring(s, 1, 1), F.substring(s, -1, 1)
    found = [(F.lit(1), end(first, N_END, POSITIVE["N-end"]), 1), (F.lit(1), end(last, C_END, NEGATIVE["C-end"]), -1)]
    found += [(_number(s, a), F.lit(pk), 1) for a, pk in POSITIVE.items() if len(a) == 1]
    return found + [(_number(s, a), F.lit(pk), -1) for a, pk in NEGATIVE.items() if len(a) == 1]


def _charge(groups, ph):
    total = F.lit(0.0)
    for n, pk, sign in groups:
        total = total + sign * n / (1 + F.pow(F.lit(10.0), sign * (ph - pk)))
    return total


def charge(seq, ph=7.4):
    """Net charge at a pH by Henderson-Hasselbalch."""
    return _charge(_groups(seq), F.lit(float(ph)))


def isoelectric_point(seq, rounds=40, low=4.05, high=12.0):
    """The pH at which the net charge is 0, by halving low..high."""
    groups = _groups(seq)
    named = F.array(*[F.struct(n.cast("double").alias("n"), pk.alias("pk"), F.lit(float(sign)).alias("sign")) for n, pk, sign in groups])

    def halve(span, _):
        middle = (span["low"] + span["high"]) / 2
        total = F.aggregate(named, F.lit(0.0), lambda t, g: t + g["sign"] * g["n"] / (1 + F.pow(F.lit(10.0), g["sign"] * (middle - g["pk"]))))
        return F.struct(F.when(total > 0, middle).otherwise(span["low"]).alias("low"), F.when(total > 0, span["high"]).otherwise(middle).alias("high"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), F.struct(F.lit(low).alias("low"), F.lit(high).alias("high")), halve, lambda span: (span["low"] + span["high"]) / 2)


def instability(seq, weights):
    """Ten times the mean weight of neighbouring residues; weights: published table of pairs, given as {"AB": weight}."""
    s = clean(seq)
    table = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
    pairs = F.transform(F.sequence(F.lit(1), F.length(s) - 1), lambda i: F.coalesce(F.element_at(table, F.substr(s, i, F.lit(2))), F.lit(0.0)))
    total = F.aggregate(pairs, F.lit(0.0), lambda t, x: t + x)
    return F.when(F.length(s) > 1, 10.0 * total / F.length(s)).otherwise(0.0)

"""Anchor search: exact, substitutions only, and indel-tolerant."""

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from quillon.functions.seq import col


def substitution_regex(anchor: str, most: int) -> str:
    """Alternatives of the anchor with any `most` letters open."""
    return "|".join("".join("." if i in free else c for i, c in enumerate(anchor)) for free in map(set, combinations(range(len(anchor)), most)))


def last_substitution_hit(seq, anchor, most):
    """1-based start of the rightmost hit with at most `most` substitutions, 0 if none.

    A greedy prefix before the alternatives stops at the rightmost start, inside one expression.
    """
    regex = f"(?s)^(.*)(?:{substitution_regex(anchor, most)})"
    return F.when(col(seq).rlike(regex), F.length(F.regexp_extract(col(seq), regex, 1)) + 1).otherwise(0)


def substitution_hit(seq, anchor, most):
    """1-based start of the first hit with at most `most` substitutions, 0 if none."""
    regex = f"(?s)^(.*?)(?:{substitution_regex(anchor, most)})"
    return F.when(col(seq).rlike(regex), F.length(F.regexp_extract(col(seq), regex, 1)) + 1).otherwise(0)


def ends_within(texts, anchor, most):
    """(row, end, distance, start) of every place where a match within `most` edits ends, of all texts at once.

    One step of the usual table a letter of the texts and the anchor, each over all rows. A cell
    is distance * 2**20 + start, so the least cell has the least distance and then the first start.
    """
    size = np.array([len(t) for t in texts], np.int64)
    longest = int(size.max(initial=0))
    if not longest:
        return [np.zeros(0, np.int64)] * 4
    text = np.array([t.ljust(longest) for t in texts]).view("<u4").reshape(len(texts), longest)
    one, found = np.int64(1 << 20), []
    row = [np.full(len(texts), i * one) for i in range(len(anchor) + 1)]
    for j in range(longest):
        new = [np.full(len(texts), j + 1)]
        for i, letter in enumerate(anchor, 1):
            cell = row[i - 1] + np.where(text[:, j] == ord(letter), 0, one)
            new.append(np.minimum(np.minimum(cell, row[i] + one), new[i - 1] + one))
        row = new
        hit = np.flatnonzero((row[-1] >> 20 <= most) & (j < size))
        found.append((hit, np.full(len(hit), j + 1), row[-1][hit] >> 20, row[-1][hit] & (one - 1)))
    return [np.concatenate(x) for x in zip(*found)]


def edit_matches_of(texts, anchor: str, most: int):
    """For each text (start, end, distance), 0-based, of its non-overlapping matches within `most` edits.

    Of overlapping matches the least distance stays, then the longest, then the leftmost.
    """
    kept = [[] for _ in texts]
    row, end, distance, start = ends_within(texts, anchor, most)
    order = np.lexsort((start, start - end, distance, row))
    for r, a, b, d in zip(row[order].tolist(), start[order].tolist(), end[order].tolist(), distance[order].tolist()):
        if all(b <= x or a >= y for x, y, _ in kept[r]):
            kept[r].append((a, b, d))
    return [sorted(k) for k in kept]


def edit_matches(seq: str, anchor: str, most: int):
    return edit_matches_of([seq], anchor, most)[0]


def edit_anchor(seq, anchor: str, most: int, low: int, high: int):
    """struct(start, end, any): leftmost match whose 0-based start is in [low, high], -1 if none.

    An exact hit there that no earlier exact hit overlaps stays in any choice, since matches that
    start in the window overlap it; locate finds it, and only the other rows' texts reach the kernel.
    """
    if high - low >= len(anchor) - most:
        raise ValueError("the window of starts must be shorter than the anchor")

    @F.pandas_udf("start int, end int, any boolean")
    def fuzzy(s: pd.Series) -> pd.DataFrame:
        out = np.full((len(s), 2), -1)
        held = np.zeros(len(s), bool)
        some = np.flatnonzero(s.notna().to_numpy())
        for i, hits in zip(some.tolist(), edit_matches_of(s.to_numpy()[some].tolist(), anchor, most)):
            held[i] = bool(hits)
            out[i] = next(((a, b) for a, b, _ in hits if low <= a <= high), (-1, -1))
        return pd.DataFrame({"start": out[:, 0].astype("int32"), "end": out[:, 1].astype("int32"), "any": held})

    s = col(seq)
    at = F.locate(anchor, s, max(low - len(anchor) + 2, 1)) - 1
    exact = F.coalesce(at.between(low, high), F.lit(False))
    # the kernel runs on every row of a batch, so rows that need it not hand it null
    other = fuzzy(F.when(~exact, s))
    pick = lambda mine, name: F.when(exact, mine).otherwise(other[name]).alias(name)
    return F.struct(pick(at, "start"), pick(at + len(anchor), "end"), pick(F.lit(True), "any"))


def edit_first(seq, anchor: str, most: int):
    """0-based start of the first match within `most` edits, -1 if none."""

    @F.pandas_udf("int")
    def first(s: pd.Series) -> pd.Series:
        hits = edit_matches_of([x or "" for x in s], anchor, most)
        return pd.Series([h[0][0] if h else -1 for h in hits], dtype="int32")

    return first(col(seq))

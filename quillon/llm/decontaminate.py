"""Benchmark decontamination by pigeonhole edit matching.

Texts are lower-cased and cut into words at spaces and ASCII punctuation. An item of m words has
an error budget k = floor(rate * m), lowered so that its k + 1 pieces have min_piece words at
least. With k edits or fewer some piece occurs unchanged, so exact piece hits find every
candidate; each is verified by Myers' bit-parallel distance of the whole item to the words there.
The span of a hit is the place of fewest edits that ends first; a second pass from that end back
over the reversed item gives its start.

The benchmark is a stated query set: it is taken in blocks of bounded size, each block matched in
one pass over all documents without a join or shuffle. Items without words match nothing; null or
empty texts contain nothing; rows that repeat are each reported. Null ids come back null. Extra
columns are ignored by find_items and passed through by drop_contaminated. An empty documents
table or benchmark gives no hits.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from quillon.llm import words as W
from quillon.session import ship_package

BREAKS = np.zeros(256, bool)
BREAKS[:128] = True
BREAKS[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
BLOCK_ITEMS = 20_000


def word_chunks(column):
    return W.chunks(pc.utf8_lower(column.cast(pa.large_string())), False, BREAKS)


def budget(m, rate, min_piece):
    return max(0, min(int(rate * m), m // min_piece - 1))


def myers_end(peq, m, text, anchored=False):
    """Least edit distance of the pattern to a substring of text, or to a prefix (anchored), and where it first ends."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    for j, w in enumerate(text):
        eq = peq.get(w, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = (ph << 1 | anchored) & full, mh << 1 & full
        pv, mv = mh | ~(xv | ph) & full, ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


def myers_span(peq, back, m, text):
    """Least edit distance to a substring of text, and the shortest such substring that ends first; back is of the reversed pattern."""
    edits, end = myers_end(peq, m, text)
    return edits, end - myers_end(back, m, text[:end][::-1], True)[1], end


def positions(words):
    peq = {}
    for i, w in enumerate(words):
        peq[w] = peq.get(w, 0) | 1 << i
    return peq


class Items:
    """One block of items: piece hashes by length, and each item's words for verification."""

    def __init__(self, rows, rate, min_piece):
        ids, texts = [r[0] for r in rows], pa.array([r[1] for r in rows], pa.string())
        self.items, by_length = [], {}
        for c in word_chunks(texts):
            for r in range(c.hi - c.lo):
                h = c.hashes[c.ptr[r] : c.ptr[r + 1]]
                if not len(h):
                    continue
                k = budget(len(h), rate, min_piece)
                at = len(self.items)
                self.items.append((ids[c.lo + r], len(h), k, positions(h.tolist()), positions(h[::-1].tolist())))
                cuts = [len(h) * i // (k + 1) for i in range(k + 2)]
                for a, b in zip(cuts, cuts[1:]):
                    by_length.setdefault(b - a, []).append((int(W.windows(h[a:b], b - a)[0]), at, a))
        self.pieces = {}
        for n, found in by_length.items():
            found.sort()
            keys = np.array([f[0] for f in found], W.U)
            bits = np.zeros(1 << 16, bool)
            bits[keys >> W.U(48)] = True
            self.pieces[n] = keys, bits, [f[1:] for f in found]

    def hits(self, c):
        """By (row, item) of every contained item: (edits, end word, first word)."""
        out, h = {}, c.hashes
        longest = max(self.pieces, default=0)
        w = h
        for n in range(1, min(longest, len(h)) + 1):
            if n > 1:
                w = W.mix64(w[:-1] * W.U(0x9E3779B97F4A7C15) + h[n - 1 :])
            if n not in self.pieces:
                continue
            keys, bits, where = self.pieces[n]
            for p in np.flatnonzero(bits[w >> W.U(48)]).tolist():
                i = int(np.searchsorted(keys, w[p]))
                if i == len(keys) or keys[i] != w[p]:
                    continue
                row = int(np.searchsorted(c.ptr, p, "right")) - 1
                lo, hi = c.ptr[row], c.ptr[row + 1]
                if p + n > hi:
                    continue
                while i < len(keys) and keys[i] == w[p]:
                    at, offset = where[i]
                    i += 1
                    _, m, k, peq, back = self.items[at]
                    a, b = max(lo, p - offset - k), min(hi, p - offset + m + k)
                    known = out.get((row, at), (m + 1, 0))
                    # what lies here unedited ends no sooner; what ends sooner has pieces of its own
                    if known[0] == 0 and known[1] <= p - offset - lo + m:
                        continue
                    edits, start, end = myers_span(peq, back, m, h[a:b].tolist())
                    # the fewest edits, then the first to end in the text
                    got = edits, int(a - lo) + end, int(a - lo) + start
                    if edits <= k and got < known:
                        out[row, at] = got
        return out


def _find(batches, items):
    for batch in batches:
        rows = []
        for c in word_chunks(batch.column("text")):
            rows += [(c.lo + r, items.items[at][0], edits, first, end) for (r, at), (edits, end, first) in items.hits(c).items()]
        if rows:
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()).take(pa.array(cols[0])), *[pa.array(x, pa.int64()) for x in cols[1:]]], ["doc_id", "item_id", "edits", "first_word", "end_word"])


def _drop(batches, items):
    for batch in batches:
        keep = np.ones(batch.num_rows, bool)
        for c in word_chunks(batch.column("text")):
            for r, _ in items.hits(c):
                keep[c.lo + r] = False
        yield batch.filter(pa.array(keep))


def item_blocks(benchmark, rate, min_piece, block_items=BLOCK_ITEMS):
    """The benchmark in blocks of about block_items items, so that what a task holds is bounded."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    n = -(-items.count() // block_items)
    for b in range(n):
        yield Items([tuple(r) for r in items.where(F.expr(f"pmod(xxhash64(item_id, text), {n}) = {b}")).collect()], rate, min_piece)


def find_items(docs, benchmark, rate=0.1, min_piece=5):
    """One row per document and contained item: doc_id, item_id, edits, first_word, end_word."""
    ship_package(docs.sparkSession)
    schema = "doc_id long, item_id long, edits long, first_word long, end_word long"
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    out = docs.sparkSession.createDataFrame([], schema)
    for i, items in enumerate(item_blocks(benchmark, rate, min_piece)):
        found = docs.mapInArrow(lambda it, items=items: _find(it, items), schema)
        out = out.unionByName(found) if i else found
    return out


def drop_contaminated(docs, benchmark, rate=0.1, min_piece=5):
    """docs without those that contain an item; all columns pass through."""
    ship_package(docs.sparkSession)
    for items in item_blocks(benchmark, rate, min_piece):
        docs = docs.mapInArrow(lambda it, items=items: _drop(it, items), docs.schema)
    return docs

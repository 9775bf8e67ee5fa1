"""Quality classifier: Bradley-Terry pairwise ranking over layout and lexical features.

A document's worth is w.x; the chance that one document beats another is the logistic of the
difference, fitted on pairs of a good and a bad document of a bounded labelled sample. Layout
features are shares of character classes, repeats and lengths; lexical features are the shares of
BUCKETS hash buckets among the document's words and word pairs. The threshold is the
training-score quantile with the fewest errors; scores are shifted so that this quantile becomes
`cut`.

Empty and null texts get the features of the empty text and so a score like any other. Labels
other than 0 and 1, or without a document, are not learned from; where one class is missing
every score is the cut. Repeated rows are each scored, and repeated labels are each learned from.
Extra columns are ignored, and passed through by drop_rejected. An empty table gives an empty result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quillon.llm import words as W
from quillon.session import ship_package

#: Labelled documents that the ranking is fitted on, at most; chosen by hash of the id.
SAMPLE_ROWS = 20_000
PAIRS = 200_000
NAMES = ("upper", "symbol", "bar", "bang", "digit", "stop", "other", "high", "length", "word", "distinct", "again", "lines")
#: Hash buckets of words and word pairs; their shares are scaled to weigh about as much as layout.
BUCKETS, SHARE_SCALE = 512, 16.0
_CLASS = np.full(256, 6, np.uint8)
for _i, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#*$%&<>", b"|", b"!", b"0123456789", b".,;:?")):
    _CLASS[list(_chars)] = _i
_CLASS[128:] = 7
_CLASS[97:123] = 8
_CLASS[[9, 10, 11, 12, 13, 32]] = 9


def lexical(c):
    """Row and bucket of each word and word pair of a chunk, and how many each row has."""
    n = c.hi - c.lo
    of = np.repeat(np.arange(n), np.diff(c.ptr))
    pairs = W.windows(c.hashes, 2)
    inside = of[1:] == of[:-1] if len(of) else np.zeros(0, bool)
    row = np.concatenate((of, of[1:][inside]))
    bucket = (W.mix64(np.concatenate((c.hashes, pairs[inside]))) % W.U(BUCKETS)).astype(np.int64)
    return row, bucket, np.maximum(np.bincount(row, minlength=n), 1)


def word_shares(column):
    """One row of BUCKETS for each text: for the bounded sample only, since it is dense."""
    out = [np.zeros((0, BUCKETS), np.float32)]
    for c in W.chunks(column):
        row, bucket, size = lexical(c)
        n = c.hi - c.lo
        out.append((np.bincount(row * BUCKETS + bucket, minlength=n * BUCKETS).reshape(n, BUCKETS) * (SHARE_SCALE / size[:, None])).astype(np.float32))
    return np.concatenate(out)


def word_scores(column, weight):
    """word_shares times a weight a bucket, without the dense shares."""
    out = [np.zeros(0)]
    for c in W.chunks(column):
        row, bucket, size = lexical(c)
        out.append(np.bincount(row, weight[bucket], c.hi - c.lo) * SHARE_SCALE / size)
    return np.concatenate(out)


def features(column):
    """One row of NAMES for each text."""
    out = []
    for c in W.chunks(column, lower=False):
        n = c.hi - c.lo
        row = np.repeat(np.arange(n), np.diff(c.offsets))
        kinds = np.bincount(row * 10 + _CLASS[c.data], minlength=n * 10).reshape(n, 10).astype(float)
        solid = np.maximum(kinds[:, :9].sum(1), 1)
        words = np.diff(c.ptr)
        some = np.maximum(words, 1)
        of = np.repeat(np.arange(n), words)
        again = np.zeros(n)
        if len(c.hashes) > 1:
            same = (c.hashes[1:] == c.hashes[:-1]) & (of[1:] == of[:-1])
            again = np.bincount(of[1:], same, n)
        distinct, lines = np.ones(n), np.zeros(n)
        ends = np.flatnonzero(c.data == 10)
        for r in range(n):
            h = np.sort(c.hashes[c.ptr[r] : c.ptr[r + 1]])
            if len(h):
                distinct[r] = (1 + np.count_nonzero(h[1:] != h[:-1])) / len(h) ** 0.9
            a, b = np.searchsorted(ends, c.offsets[r : r + 2])
            if b - a > 1:
                rows = c.data[c.offsets[r] : c.offsets[r + 1]].tobytes().split(b"\n")
                lines[r] = 1 - len(set(rows)) / len(rows)
        share = kinds[:, [0, 1, 2, 3, 4, 5, 6, 7]] / solid[:, None]
        out.append(np.column_stack([np.sqrt(share), np.log1p(words), np.minimum(solid / some, 20) / 10, distinct, np.sqrt(again / some), np.sqrt(lines)]))
    return np.concatenate(out) if out else np.zeros((0, len(NAMES)))


def held_out(doc_id):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def _feature_batches(batches, rows=256):
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            b = batch.slice(lo, rows)
            x = np.column_stack([features(b.column("text")), word_shares(b.column("text"))]).astype("<f4")
            yield pa.RecordBatch.from_arrays([b.column("quality"), pa.array([r.tobytes() for r in x], pa.binary())], ["quality", "x"])


def fit_pairs(x, y, pairs=PAIRS, seed=7, steps=400, ridge=1e-3):
    """Weights of the Bradley-Terry model on random good-bad pairs, by accelerated gradient steps.

    The gradient over pairs is gathered by document first, so no matrix of pairs is made.
    """
    rng = np.random.default_rng(seed)
    good, bad = rng.choice(np.flatnonzero(y == 1), pairs), rng.choice(np.flatnonzero(y == 0), pairs)
    gather = lambda p: x.T @ (np.bincount(good, p, len(y)) - np.bincount(bad, p, len(y))) / pairs
    v = np.ones(x.shape[1]) / np.sqrt(x.shape[1])
    for _ in range(30):
        s = x @ v
        v = gather(s[good] - s[bad])
        size = np.linalg.norm(v)
        v /= max(size, 1e-12)
    step = 1 / (0.3 * size + ridge)
    w = ahead = np.zeros(x.shape[1])
    for t in range(steps):
        s = x @ ahead
        new = ahead + step * (gather(1 / (1 + np.exp(np.clip(s[good] - s[bad], -30, 30)))) - ridge * ahead)
        ahead = new + t / (t + 3) * (new - w)
        w = new
    return w


class Ranker:
    def __init__(self, x, y, cut):
        self.cut = cut
        self.center, self.scale = 0, 1
        if len(x):
            # a few columns at a time, as the driver should hold one copy of the rows in doubles and no more
            sums = [(part.mean(0), part.std(0)) for part in (x[:, a : a + 64].astype(float) for a in range(0, x.shape[1], 64))]
            self.center, self.scale = np.concatenate([m for m, _ in sums]), np.concatenate([d for _, d in sums]) + 1e-6
            self.scale[len(NAMES) :] = 1
        self.w, self.at, self.spread = None, 0.0, 1.0
        if len(np.unique(y)) == 2:
            z = x.astype(float)
            z -= self.center
            z /= self.scale
            self.w = fit_pairs(z, y)
            s = z @ self.w
            order = np.argsort(s, kind="stable")
            s, y = s[order], y[order]
            wrong = np.concatenate(([0], np.cumsum(y == 1))) + np.concatenate((np.cumsum((y == 0)[::-1])[::-1], [0]))
            q = int(np.argmin(wrong))
            below, above = s[max(q - 1, 0)], s[min(q, len(s) - 1)]
            self.at, self.spread = below + 0.25 * (above - below), s.std() + 1e-9

    def scores(self, column):
        """Scores of a text column."""
        x = features(column)
        if self.w is None:
            return np.full(len(x), self.cut)
        layout, words, k = self.w[: len(NAMES)], self.w[len(NAMES) :], len(NAMES)
        worth = ((x - self.center[:k]) / self.scale[:k]) @ layout + word_scores(column, words) - self.center[k:] @ words
        return 1 / (1 + np.exp(-np.clip(np.log(self.cut / (1 - self.cut)) + 2 * (worth - self.at) / self.spread, -40, 40)))


def fit(docs, labels, cut=0.3, sample_rows=SAMPLE_ROWS):
    """A Ranker from at most sample_rows labelled documents outside the held-out fifth."""
    ship_package(docs.sparkSession)
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where(F.col("quality").isin(0, 1) & ~held_out("doc_id"))
        .orderBy(F.xxhash64("doc_id"), "quality")
        .limit(sample_rows)
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    got = rows.select("quality", "text").mapInArrow(_feature_batches, "quality int, x binary").toArrow()
    y, width = got.column("quality").to_numpy(), len(NAMES) + BUCKETS
    x = np.empty((len(y), width), "<f4")
    at = 0
    for part in got.column("x").chunks:
        x[at : at + len(part)] = np.frombuffer(part.cast(pa.binary(4 * width)).buffers()[1], "<f4", len(part) * width, part.offset * 4 * width).reshape(-1, width)
        at += len(part)
    del got
    pa.default_memory_pool().release_unused()
    order = np.lexsort((y, x.view(f"S{4 * width}").ravel())) if len(y) else np.zeros(0, int)  # the same fit in whatever order rows came
    return Ranker(x[order], y[order], cut)


def _score_batches(batches, ranker):
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(ranker.scores(b.column("text")))], ["doc_id", "held_out", "score"])


def _keep_batches(batches, ranker):
    for b in batches:
        yield b.filter(pa.array(ranker.scores(b.column("text")) >= ranker.cut))


def score(docs, ranker):
    """doc_id, held_out, score, predicted."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    out = rows.mapInArrow(lambda it: _score_batches(it, ranker), "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= ranker.cut).cast("int"))


def drop_rejected(docs, ranker):
    return docs.mapInArrow(lambda it: _keep_batches(it, ranker), docs.schema)

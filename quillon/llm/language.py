"""Language identification by the nearest of several TF-IDF centroids per language.

Texts are lower-cased; byte trigrams inside and at the edges of letter runs are hashed to `DIM`
counts, damped, weighted by inverse document frequency and normalised. Each language of a
bounded training sample, of every language that has a row, is split into centroids by spherical k-means. A text gets the language
of the nearest centroid by cosine; it is also marked rejected when it lies farther from that
centroid than nearly all of the language's training texts.

Null texts and texts without a letter are `und` with score 0. Rows without a language, or whose
id is null, teach nothing; with nothing to learn from every text is `und`. Repeated rows are each
judged. Extra columns are ignored. An empty table gives an empty result.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from quillon.llm import words as W
from quillon.llm.near_dedup import small_or_not
from quillon.llm.quality import held_out
from quillon.session import ship_package

DIM = 4096
#: Training texts of all languages together, about so many at most, but LEAST of each language that has them.
SAMPLE_ROWS, LEAST = 3000, 12
#: Texts whose dense counts (16 KB each) are held at once.
ROWS = 512
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def counts(column):
    """(first row, matrix of damped trigram counts) for parts of a text column."""
    data, offsets = W.text_buffers(pc.utf8_lower(column.cast(pa.large_string())))
    for lo, hi in W.pieces(offsets, rows=ROWS):
        b = _FOLD[data[offsets[lo] : offsets[hi]]].astype(np.uint32)
        offs = offsets[lo : hi + 1] - offsets[lo]
        n = hi - lo
        tf = np.zeros((n, DIM), np.float32)
        if len(b):
            before, after = np.empty_like(b), np.empty_like(b)
            before[0] = after[-1] = 32
            before[1:], after[:-1] = b[:-1], b[1:]
            full = np.flatnonzero(np.diff(offs))
            before[offs[full]] = after[offs[full + 1] - 1] = 32
            key = (before * np.uint32(0x9E3779B1) ^ b * np.uint32(0x85EBCA6B) ^ after * np.uint32(0xC2B2AE35)) * np.uint32(0x27D4EB2F) >> np.uint32(20)
            row = np.repeat(np.arange(n) * DIM, np.diff(offs))
            keep = b != 32
            tf = np.bincount((row + key)[keep], minlength=n * DIM).reshape(n, DIM).astype(np.float32)
        yield lo, np.log1p(tf)


def has_letter(column):
    return pc.fill_null(pc.match_substring_regex(column.cast(pa.large_string()), r"\p{L}"), False).to_numpy(zero_copy_only=False)


def _sample_batches(batches):
    for b in batches:
        for lo, tf in counts(b.column("text")):
            yield pa.RecordBatch.from_arrays([b.column("lang").slice(lo, len(tf)), pa.array([x.tobytes() for x in tf.astype(np.float16)], pa.binary())], ["lang", "tf"])


def _unit(x):
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-9)


def spherical_kmeans(x, k, rounds=12):
    """Centroids of unit rows, from a farthest-first start; fewer when there are fewer rows."""
    c = [_unit(x.mean(0))]
    far = x @ c[0]
    while len(c) < min(k, len(x)):
        c.append(x[int(np.argmin(far))])
        far = np.maximum(far, x @ c[-1])
    c = np.array(c)
    for _ in range(rounds):
        own = np.argmax(x @ c.T, 1)
        c = np.array([_unit(x[own == i].mean(0)) if (own == i).any() else c[i] for i in range(len(c))])
    return c


class Centroids:
    def __init__(self, langs, tf, k, reject_share):
        self.langs = sorted(set(langs))
        self.idf = np.log((1 + len(tf)) / (1 + (tf > 0).sum(0))).astype(np.float32) + 1
        x = _unit(tf * self.idf)
        cents, self.of, self.radius = [], [], []
        for i, lang in enumerate(self.langs):
            mine = x[np.array(langs) == lang]
            c = spherical_kmeans(mine, k)
            near = mine @ c.T
            own = near.argmax(1)
            cents.append(c)
            self.of += [i] * len(c)
            self.radius += [float(np.quantile(near[own == j, j], reject_share)) if (own == j).any() else -1.0 for j in range(len(c))]
        self.c, self.of, self.radius = np.concatenate(cents).astype(np.float32), np.array(self.of), np.array(self.radius)

    def predict(self, tf, sharpness=20.0):
        cos = _unit(tf * self.idf) @ self.c.T
        by = np.maximum.reduceat(cos, np.flatnonzero(np.diff(self.of, prepend=-1)), 1)
        best = by.argmax(1)
        e = np.exp(sharpness * (by - by.max(1, keepdims=True)))
        near = cos.argmax(1)
        return best, (e.max(1) / e.sum(1)).astype(float), cos.max(1) < self.radius[near]


def _predict_batches(batches, model):
    for b in batches:
        text = b.column("text")
        lang, score, reject = np.full(len(text), "und", object), np.zeros(len(text)), np.ones(len(text), bool)
        if model:
            for lo, tf in counts(text):
                best, s, r = model.predict(tf)
                part = slice(lo, lo + len(tf))
                lang[part], score[part], reject[part] = np.array(model.langs, object)[best], s, r
            none = ~has_letter(text)
            lang[none], score[none], reject[none] = "und", 0.0, True
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(lang, pa.string()), pa.array(score), pa.array(reject)], ["doc_id", "held_out", "lang_pred", "score", "rejected"])


def fit(docs, centroids=4, sample_rows=SAMPLE_ROWS, reject_share=0.001, least=LEAST):
    """Centroids of every language, from about sample_rows texts, evenly by language, outside the held-out fifth.

    A language has `least` texts at least, where it has them, however many languages there are.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id")).where(F.col("lang").isNotNull() & ~held_out("doc_id"))
    by = rows.groupBy("lang").agg(F.count("*").alias("n"))
    # every text of a language counts when it has few; twice `least` are drawn, so that `least` are there
    each = max(sample_rows // max(by.count(), 1), 2 * least)
    by = small_or_not(by.withColumn("share", F.least(F.lit(1.0), each / F.col("n"))))
    chosen = rows.join(by, "lang").where(F.expr("pmod(xxhash64(doc_id, 11), 1000000) < share * 1000000"))
    got = chosen.select("lang", "text").mapInArrow(_sample_batches, "lang string, tf binary").toArrow()
    langs, raw = got.column("lang").to_pylist(), got.column("tf").to_pylist()
    order = sorted(range(len(langs)), key=lambda i: (langs[i], raw[i]))
    tf = np.array([np.frombuffer(raw[i], np.float16) for i in order], np.float32).reshape(len(order), DIM)
    some = tf.sum(1) > 0
    langs = [langs[i] for i, ok in zip(order, some) if ok]
    return Centroids(langs, tf[some], centroids, reject_share) if langs else None


def predict(docs, model):
    """doc_id, held_out, lang_pred, score, rejected."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda it: _predict_batches(it, model), "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")

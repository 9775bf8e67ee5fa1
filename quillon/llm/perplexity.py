"""Quality rules with an n-gram perplexity band.

The language model runs over a text's words joined by single spaces and predicts each byte, and
the space after each word, from the five bytes before it, whatever words these belong to. Spark
counts the six-byte strings by language and estimates interpolated modified Kneser-Ney
probabilities order by order; discounts come from the counts of counts. Only documents that pass
the base rules teach, and no passage is judged by a model that it or a copy of it taught: texts
are cut before words that their hash picks, each cut falls into one of two folds by its first
three words, and each fold is scored with the counts of the other. Strings of the other documents
stay in the model with a count of 0, so every string that is judged has an entry, and what backing
off gives it is worked out once.

The model is stored as flat files of sorted string hashes, each beside its two log probabilities
as fixed-point integers, in shards by hash range. Tasks map the files and look strings up by
binary search; sums of integers do not depend on their order. Documents outside their band of
perplexity, `width` quartile ranges beyond the quartiles of their language and length (powers of
two of words, as short texts vary more), are not kept, nor those that fail the base rules. A
length that has few documents takes its language's quartiles, widened for texts of few words.

Null texts have no words and fail the base rules; a null language is a language of its own.
Documents without words have no perplexity. Repeated rows are each judged, and each counted. Extra columns are ignored. An empty table gives an empty result.
"""

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Window, functions as F

from quillon.llm import words as W
from quillon.llm.near_dedup import small_or_not
from quillon.llm.token_files import filesystem
from quillon.session import materialize, ship_package, work_path

U = W.U
ORDER = 6
#: Log probabilities are kept in steps of 1 / SCALE.
SCALE = 1 << 16
#: One word in so many starts a cut; a power of two.
CUT = 8
#: Strings that a counting task holds before it passes them on.
HELD = 2_000_000
#: So many languages of a chunk fit above a string and its state in 64 bits.
NAMES = 1 << 62 - 8 * ORDER
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def strings(c, order=ORDER):
    """The string that ends at each symbol of a chunk's texts, the symbol's row, and its fold."""
    rows = c.hi - c.lo
    of = np.repeat(np.arange(rows), np.diff(c.ptr))
    size = c.ends - c.starts + 1
    place = np.cumsum(size) - size + (order - 1) * (of + 1)
    b = np.full(int(size.sum()) + (order - 1) * rows, 32, U)
    solid = np.flatnonzero(~W.SPACE[c.data])
    b[solid + np.repeat(place - c.starts, size - 1)] = c.data[solid]
    row = np.repeat(of, size)
    at = np.arange(len(row)) + (order - 1) * (row + 1)
    # over the whole line first, as shifts of neighbours are cheaper than picking bytes for each string
    g = b.copy()
    for i in range(1, order):
        g[i:] |= b[:-i] << U(8 * i)
    return g[at], row, np.repeat(folds(c, of), size)


def distinct(keys):
    """Sorted distinct keys; the order that sorts all, and the place in the distinct ones of each in that order."""
    n = len(keys)
    low = (U(1) << U(max(n.bit_length(), 1))) - U(1)
    # most of a key and its place in one number: sorting values is cheaper than sorting places
    order = (np.sort(((keys.view(U) ^ U(1 << 63)) & ~low) | np.arange(n, dtype=U)) & low).astype(np.int64)
    k = keys[order]
    if (k[1:] < k[:-1]).any():  # keys that differ only in the bits left out
        order = np.argsort(keys, kind="stable")
        k = keys[order]
    new = np.concatenate((np.ones(min(n, 1), bool), k[1:] != k[:-1]))
    return k[new], order, np.cumsum(new) - 1


def folds(c, of):
    """The fold of each word, by the cut it is in: copies of a passage fall into the same one, but for its ends."""
    n = len(c.hashes)
    if not n:
        return np.zeros(0, np.int64)
    cut = (c.hashes & U(CUT - 1)) == 0
    cut[1:] |= of[1:] != of[:-1]
    cut[0] = True
    named = c.hashes
    for i in (1, 2):
        after = np.zeros(n, U)
        after[:-i] = np.where(of[i:] == of[:-i], c.hashes[i:], U(0))
        named = W.mix64(named + after * U(2 * i + 1))
    return (named & U(1)).astype(np.int64)[np.maximum.accumulate(np.where(cut, np.arange(n), 0))]


def base_columns(c):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a chunk's rows."""
    n = c.hi - c.lo
    row = np.repeat(np.arange(n), np.diff(c.offsets))
    chars = np.bincount(row[~W.SPACE[c.data] & ((c.data & 0xC0) != 0x80)], minlength=n)
    symbols = np.bincount(row[SYMBOLS[c.data]], minlength=n)
    lines = np.zeros(n, np.int64)
    for r in range(n):
        text = c.data[c.offsets[r] : c.offsets[r + 1]].tobytes()
        if b"\n" in text:
            full = [x for x in text.split(b"\n") if x.strip(b" \t\n\v\f\r")]
            lines[r] = len(full) - len(set(full))
    words = np.diff(c.ptr)
    repeat = np.zeros(n, np.int64)
    w = W.windows(c.hashes, 5)
    if len(w):
        of = np.repeat(np.arange(n), words)
        ok = np.flatnonzero(of[: len(w)] == of[4:])
        _, inverse, count = np.unique(w[ok] ^ W.mix64(of[ok].astype(U) + U(5)), return_inverse=True, return_counts=True)
        again = ok[count[inverse] > 1]
        cover = np.zeros(len(c.hashes) + 1, np.int64)
        np.add.at(cover, again, 1)
        np.add.at(cover, again + 5, -1)
        repeat = np.bincount(of[np.cumsum(cover[:-1]) > 0], minlength=n)
    return np.column_stack([words, chars, symbols, lines, repeat]).astype(np.int64)


def fails(base):
    """Whether rows of base columns break the base rules."""
    return (base[:, 0] < 10) | (100 * base[:, 4] > 20 * base[:, 0])


class _Counts:
    """Strings of one language with their counts in both folds; 0 for those that only failed texts hold."""

    def __init__(self):
        self.parts, self.held = [], 0

    def add(self, k, state, n):
        """n strings k each; state is the fold that they teach, 2 for those of texts that don't."""
        for f in (0, 1):
            self._put(k[state == f], n[state == f], f)
        self._put(k[state == 2], 0, 0)
        if self.held > HELD:
            self.fold()

    def _put(self, k, n, f):
        if len(k):
            c = np.zeros((len(k), 2), np.int64)
            c[:, f] = n
            self.parts.append((k, c))
            self.held += len(k)

    def fold(self):
        k, i = np.unique(np.concatenate([p[0] for p in self.parts]), return_inverse=True)
        c = np.concatenate([p[1] for p in self.parts])
        self.parts = [(k, np.column_stack([np.bincount(i, c[:, f], len(k)) for f in (0, 1)]).astype(np.int64))]
        self.held = len(k)


def _emit(lang, counts, step=200_000):
    counts.fold()
    ((k, c),) = counts.parts
    for lo in range(0, len(k), step):
        part = slice(lo, lo + step)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k[part]), pa.string()), pa.array(k[part].view(np.int64)), pa.array(c[part, 0]), pa.array(c[part, 1])], ["lang", "g", "c0", "c1"])


def _count_batches(batches):
    """lang, g, c0, c1: partial counts, passed on whenever a language holds too many strings."""
    by_lang = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for c in W.chunks(batch.column("text"), lower=False):
            g, row, fold = strings(c)
            names, name = np.unique(np.array(langs[c.lo : c.hi], object), return_inverse=True)
            # one sort a chunk: rows of a language lie together, its strings in order, equal ones by state
            state = np.where(~fails(base_columns(c))[row], fold, 2).astype(U)
            packed = (g << U(2)) | state
            cuts = np.arange(len(names) + 1)
            if len(names) < NAMES:
                packed = np.sort(packed | (name.astype(U)[row] << U(8 * ORDER + 2)))
                ends = np.searchsorted(packed, cuts.astype(U) << U(8 * ORDER + 2))
            else:
                by = np.lexsort((packed, name[row]))
                packed, ends = packed[by], np.searchsorted(name[row][by], cuts)
            for i, lang in enumerate(names):
                mine = packed[ends[i] : ends[i + 1]] & U((1 << 8 * ORDER + 2) - 1)
                if not len(mine):
                    continue
                first = np.flatnonzero(np.concatenate(([True], mine[1:] != mine[:-1])))
                counts = by_lang.setdefault(lang, _Counts())
                counts.add(mine[first] >> U(2), mine[first] & U(3), np.diff(np.append(first, len(mine))))
                if counts.held > HELD // 2:
                    yield from _emit(lang, by_lang.pop(lang))
    for lang, counts in by_lang.items():
        yield from _emit(lang, counts)


def kneser_ney(counts, order=ORDER):
    """lang, g, lp0, lp1 of every string: its log probability in the models of both folds, in steps of 1 / SCALE."""
    tables = {order: counts}
    for n in range(order - 1, 0, -1):
        longer = tables[n + 1].groupBy("lang", F.expr(f"g & {(1 << 8 * n) - 1}L").alias("g"))
        tables[n] = materialize(longer.agg(*[F.count_if(F.col(f"c{f}") > 0).alias(f"c{f}") for f in (0, 1)]), f"order{n}")
    lower = None
    for n in range(1, order + 1):
        t = tables[n]
        d = t.groupBy("lang").agg(*[F.count_if(F.col(f"c{f}") == i).cast("double").alias(f"n{i}_{f}") for f in (0, 1) for i in (1, 2, 3, 4)])
        for f in (0, 1):
            d = d.withColumn(f"y{f}", F.expr(f"coalesce(try_divide(n1_{f}, n1_{f} + 2 * n2_{f}), 0.5)"))
            for i in (1, 2, 3):
                d = d.withColumn(f"d{i}_{f}", F.expr(f"least(greatest(coalesce({i} - {i + 1} * y{f} * try_divide(n{i + 1}_{f}, n{i}_{f}), 0.75), 0.05), {i} - 0.05)"))
        own = Window.partitionBy("lang", "h")
        t = t.withColumn("h", F.expr("shiftright(g, 8)")).join(F.broadcast(d.select("lang", *[f"d{i}_{f}" for f in (0, 1) for i in (1, 2, 3)])), "lang")
        for f in (0, 1):
            c = f"c{f}"
            # whole numbers are summed, so the result does not depend on the order of rows
            t = t.withColumn("total", F.sum(c).over(own))
            number = {i: F.sum(F.when(F.col(c) == i, 1).otherwise(0)).over(own) for i in (1, 2)}
            more = F.sum(F.when(F.col(c) > 2, 1).otherwise(0)).over(own)
            t = t.withColumn("spare", F.when(F.col("total") > 0, (number[1] * F.col(f"d1_{f}") + number[2] * F.col(f"d2_{f}") + more * F.col(f"d3_{f}")) / F.col("total")).otherwise(1.0))
            cut = F.expr(f"CASE WHEN {c} = 0 THEN 0 WHEN {c} = 1 THEN d1_{f} WHEN {c} = 2 THEN d2_{f} ELSE d3_{f} END")
            t = t.withColumn(f"own{f}", F.when(F.col("total") > 0, (F.col(c) - cut) / F.col("total")).otherwise(0.0)).withColumnRenamed("spare", f"spare{f}").drop("total")
        if lower is None:
            t = t.withColumns({f"p{f}": F.col(f"own{f}") + F.col(f"spare{f}") / 256 for f in (0, 1)})
        else:
            shorter = lower.select("lang", F.col("g").alias("tail"), F.col("p0").alias("q0"), F.col("p1").alias("q1"))
            t = t.withColumn("tail", F.expr(f"g & {(1 << 8 * (n - 1)) - 1}L")).join(shorter, ["lang", "tail"])
            t = t.withColumns({f"p{f}": F.col(f"own{f}") + F.col(f"spare{f}") * F.col(f"q{f}") for f in (0, 1)})
        lower = materialize(t.select("lang", "g", "p0", "p1"), f"prob{n}")
    return lower.select("lang", "g", *[F.round(F.ln(f"p{f}") * SCALE).cast("int").alias(f"lp{f}") for f in (0, 1)])


def _seed(lang):
    return U(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def _key_batches(batches):
    for b in batches:
        g, langs = b.column("g").to_numpy().view(U), b.column("lang").to_pylist()
        seeds = {x: _seed(x) for x in set(langs)}
        key = W.mix64(g ^ np.array([seeds[x] for x in langs], U)).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(key), b.column("lp0"), b.column("lp1")], ["key", "lp0", "lp1"])


def _write_batches(batches, folder):
    """One shard a task: sorted keys and, beside them, both log probabilities."""
    fs, base = filesystem(folder)
    fs.create_dir(base, recursive=True)
    name, first, n = uuid.uuid4().hex, None, 0
    with fs.open_output_stream(f"{base}/{name}.keys") as keys, fs.open_output_stream(f"{base}/{name}.logp") as logp:
        for b in batches:
            if not b.num_rows:
                continue
            key = b.column("key").to_numpy()
            first = int(key[0]) if first is None else first
            keys.write(key.astype("<i8").tobytes())
            logp.write(np.column_stack([b.column(f"lp{f}").to_numpy() for f in (0, 1)]).astype("<i4").tobytes())
            n += len(key)
    if n:
        yield pa.RecordBatch.from_pylist([{"first": first, "n": n, "path": f"{folder}/{name}"}], pa.schema([("first", pa.int64()), ("n", pa.int64()), ("path", pa.string())]))


def write_model(model):
    """Writes the shards; returns their (first key, path), sorted: a few numbers a shard."""
    spark = model.sparkSession
    folder = work_path(spark, "model")
    keyed = model.mapInArrow(_key_batches, "key long, lp0 int, lp1 int")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    shards = keyed.repartitionByRange(n, "key").sortWithinPartitions("key").mapInArrow(lambda it: _write_batches(it, folder), "first long, n long, path string")
    # only shards named here are part of the model, so a task that ran twice leaves an unread file
    return sorted((r.first, r.path) for r in materialize(shards, "shards").collect())


class HashArrays:
    """Sorted hashes of (language, string), looked up in mapped files; on other storage a shard is read at a time."""

    def __init__(self, shards):
        self.firsts = np.array([f for f, _ in shards], np.int64)
        self.paths = [p for _, p in shards]
        self.mapped = {}

    def _shard(self, i):
        if i in self.mapped:
            return self.mapped[i]
        fs, path = filesystem(self.paths[i])
        if isinstance(fs, pafs.LocalFileSystem):
            self.mapped[i] = np.memmap(f"{path}.keys", "<i8", "r"), np.memmap(f"{path}.logp", "<i4", "r").reshape(-1, 2)
            return self.mapped[i]
        load = lambda end, kind: np.frombuffer(fs.open_input_file(path + end).read(), kind)
        return load(".keys", "<i8"), load(".logp", "<i4").reshape(-1, 2)

    def lookup(self, keys):
        """Both log probabilities of sorted distinct keys; every key that was counted is there."""
        out = np.zeros((len(keys), 2), np.int64)
        cuts = np.searchsorted(keys, self.firsts)
        for i, (lo, hi) in enumerate(zip(cuts, [*cuts[1:], len(keys)])):
            if lo < hi:
                known, logp = self._shard(i)
                at = np.minimum(np.searchsorted(known, keys[lo:hi]), len(known) - 1)
                if (known[at] != keys[lo:hi]).any():
                    raise ValueError("a string is not in the model: the documents differ from those counted")
                out[lo:hi] = logp[at]
        return out


def _judge_batches(batches, shards):
    model = HashArrays(shards)
    for batch in batches:
        rows, logp, symbols = [], [], []
        langs = batch.column("lang").to_pylist()
        seeds = {x: _seed(x) for x in set(langs)}
        for c in W.chunks(batch.column("text"), lower=False):
            rows.append(base_columns(c))
            n = c.hi - c.lo
            g, row, fold = strings(c)
            symbols.append(np.bincount(row, minlength=n))
            sums = np.zeros(n, np.int64)
            if len(g):
                seed = np.array([seeds[x] for x in langs[c.lo : c.hi]], U)
                keys, order, at = distinct(W.mix64(g ^ seed[row]).view(np.int64))
                value = model.lookup(keys).ravel()[2 * at + 1 - fold[order]]
                # whole numbers below 2**53: their sums are exact
                sums = np.bincount(row[order], value, n).astype(np.int64)
            logp.append(sums)
        if rows:
            table = np.concatenate(rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), *[pa.array(table[:, i]) for i in range(5)], pa.array(np.concatenate(symbols).astype(np.int64)), pa.array(np.concatenate(logp))], ["doc_id", "lang", *BASE, "symbols", "logp"])


def judge(docs, width=1.5, short=30, few=30):
    """One row per document: doc_id, BASE, base_failed, perplexity, kept."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), F.col("text").cast("string").alias("text"))
    counted = docs.select("lang", "text").mapInArrow(_count_batches, "lang string, g long, c0 long, c1 long")
    counts = materialize(counted.groupBy("lang", "g").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1")), "counts")
    shards = write_model(kneser_ney(counts))
    shape = f"doc_id long, lang string, {', '.join(f'{c} long' for c in BASE)}, symbols long, logp long"
    seen = materialize(docs.mapInArrow(lambda it: _judge_batches(it, shards), shape), "judged")
    seen = seen.withColumn("base_failed", F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words"))
    seen = seen.withColumn("level", F.when(F.col("symbols") > 0, -F.col("logp") / (F.col("symbols") * SCALE)))
    # exact quartiles of the levels in thousandths: one row a step of the scale
    seen = seen.withColumn("step", F.round(F.col("level") * 1000).cast("long"))
    seen = seen.withColumn("length", F.expr("cast(least(greatest(floor(log2(greatest(n_words, 1))), 3), 10) as int)"))
    steps = materialize(seen.where(~F.col("base_failed")).groupBy("lang", "length", "step").count(), "steps")

    def quartiles(by, names):
        t = steps.groupBy(*by, "step").agg(F.sum("count").alias("count"))
        t = t.withColumn("upto", F.sum("count").over(Window.partitionBy(*by).orderBy("step"))).withColumn("all", F.sum("count").over(Window.partitionBy(*by)))
        at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("all"), F.col("step")))
        return t.groupBy(*by).agg(at(0.25).alias(names[0]), at(0.75).alias(names[1]), F.max("all").alias(names[2]))

    # a row a language, or eight: a few languages hold most documents, so these are not dealt by language
    by_lang, by_length = (materialize(quartiles(by, names), "quartiles") for by, names in ((["lang"], ("p1", "p3", "_")), (["lang", "length"], ("q1", "q3", "n"))))
    out = seen.join(small_or_not(by_lang), "lang", "left").join(small_or_not(by_length), ["lang", "length"], "left")
    enough = F.coalesce(F.col("n") >= few, F.lit(False))
    out = out.withColumn("low", F.when(enough, F.col("q1")).otherwise(F.col("p1"))).withColumn("high", F.when(enough, F.col("q3")).otherwise(F.col("p3")))
    range_ = F.col("high") - F.col("low")
    slack = F.when(enough, 0).otherwise(F.lit(short) / F.greatest(F.col("n_words"), F.lit(1)) * (width + 0.5) * range_)
    inside = F.coalesce(F.col("step").between(F.col("low") - width * range_ - slack, F.col("high") + width * range_ + slack), F.lit(False))
    return out.select("doc_id", *BASE, "base_failed", F.exp("level").alias("perplexity"), (~F.col("base_failed") & inside).alias("kept"))

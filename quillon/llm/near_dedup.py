"""MinHash near-duplicate groups with tensored banding.

Two collections of `bundles` MinHash bundles (`rows` minima each) are computed per distinct
shingle set; table (i, j) is keyed by bundle i of the first and bundle j of the second, so
bundles**2 tables of 2*rows minima cost only 2*bundles*rows hash functions. At similarity s a
pair meets in some table with probability (1 - (1 - s**rows)**bundles)**2: 0.99991 at s = 0.8
with the default 14 bundles of 3. Links are confirmed on full shingle sets.

Equal sets are collapsed first. Buckets are then resolved in three rounds, each verified and
contracted before the next: the smallest id of each document's buckets, the member of least hash
in each bucket that still spans groups, and finally every pair of a bucket that is still in
different groups and whose sizes, shared shingles and parity sketches allow the similarity, once
a pair. So no candidate link between groups is lost, yet a large group of copies costs a few pairs
a document: buckets order their members by one hash, so those of a document mostly agree on it. A parity sketch has a bit for each of SKETCH_BITS hash values, set if an odd number of
shingles has that value: two sketches differ in no more bits than the sets differ in shingles.

Null or wordless texts have no shingles and link with nothing; rows without an id are returned
with a null component and kept. Rows that repeat an id are each returned, grouped by their own text.
Extra columns are ignored. An empty table gives an empty result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quillon.llm import words as W
from quillon.llm.buckets import crowded_ranges, shared_members
from quillon.llm.components import components
from quillon.session import discard, materialize, ship_package

U = W.U
#: A broadcast id list has at most this many rows (16 bytes each and some overhead).
BROADCAST_ROWS = 2_000_000
SKETCH_BITS = 1024
#: One set in so many shows which keys are crowded.
SAMPLE = 16


def _seeds(n, salt):
    x = W.mix64(np.arange(1, n + 1, dtype=U) * U(0xA0761D6478BD642F) + U(salt))
    return x | U(1), W.mix64(x + U(7))


def signature_batches(batches, shingle, bundles, rows):
    """doc_id, n, two sums that name the set, the bundles of both collections, and the parity sketch."""
    mul, add = _seeds(2 * bundles * rows, 12345)
    for batch in batches:
        out = []
        ids = batch.column("doc_id")
        for c in W.chunks(batch.column("text")):
            sets = list(W.shingle_sets(c, shingle))
            n = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(n)
            h1, h2 = np.zeros(len(n), U), np.zeros(len(n), U)
            sig = np.zeros((2 * bundles, len(n)), U)
            sketch = np.zeros((SKETCH_BITS // 64, len(n)), U)
            if len(full):
                x = np.concatenate([sets[i] for i in full])
                at = np.concatenate(([0], np.cumsum(n[full])[:-1]))
                h1[full] = np.add.reduceat(x, at)
                h2[full] = np.add.reduceat(W.mix64(x ^ U(0x632BE59BD9B4E019)), at)
                place = W.mix64(x ^ U(0x2545F4914F6CDD1D)) % U(SKETCH_BITS)
                bit = U(1) << (place & U(63))
                for w in range(len(sketch)):
                    sketch[w, full] = np.bitwise_xor.reduceat(np.where(place >> U(6) == w, bit, U(0)), at)
                for b in range(2 * bundles):
                    key = np.full(len(full), b + 1, U)
                    for r in range(rows):
                        i = b * rows + r
                        key = W.mix64(key * U(0x9E3779B97F4A7C15) + np.minimum.reduceat((x ^ add[i]) * mul[i], at))
                    sig[b, full] = key
            flat = np.ascontiguousarray(sig.T).view(np.int64)
            lists = lambda a: pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(a).ravel()), a.shape[1]).cast(pa.list_(pa.int64()))
            out.append(pa.RecordBatch.from_arrays([ids.slice(c.lo, c.hi - c.lo).cast(pa.int64()), pa.array(n), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), lists(flat[:, :bundles]), lists(flat[:, bundles:]), lists(np.ascontiguousarray(sketch.T).view(np.int64))], ["doc_id", "n", "h1", "h2", "left", "right", "sketch"]))
        yield from out


def _linked_batches(batches, shingle, num, den):
    for batch in batches:
        offsets = [W.text_buffers(batch.column(t))[1] for t in ("ta", "tb")]
        # a few texts at a time, so that their sets stay small whatever the batch holds
        for lo, hi in W.pieces(sum(o - o[0] for o in offsets), 4 * W.CHUNK):
            part = batch.slice(lo, hi - lo)
            sides = [[s for c in W.chunks(part.column(t)) for s in W.shingle_sets(c, shingle)] for t in ("ta", "tb")]
            ok = np.zeros(part.num_rows, bool)
            for i, (a, b) in enumerate(zip(*sides)):
                common = len(np.intersect1d(a, b, assume_unique=True))
                ok[i] = common > 0 and den * common >= num * (len(a) + len(b) - common)
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["u", "v"]).filter(pa.array(ok))


def _set_batches(batches, shingle):
    for batch in batches:
        for c in W.chunks(batch.column("text")):
            sets = list(W.shingle_sets(c, shingle))
            ends = np.concatenate(([0], np.cumsum([len(x) for x in sets])))
            flat = np.concatenate(sets).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(c.lo, c.hi - c.lo), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], ["id", "shingles"])


def small_or_not(df, limit=BROADCAST_ROWS):
    """df with a broadcast hint when its counted rows are within the limit, else as it is."""
    return F.broadcast(df) if df.count() <= limit else df


def near_dups(docs, shingle=5, num=80, den=100, bundles=14, rows=3):
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable), kept."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sig = materialize(docs.mapInArrow(lambda it: signature_batches(it, shingle, bundles, rows), "doc_id long, n long, h1 long, h2 long, left array<long>, right array<long>, sketch array<long>"), "signatures")
    classes = materialize(sig.where("n > 0 and doc_id is not null").groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("id"), F.first("left").alias("left"), F.first("right").alias("right"), F.first("sketch").alias("sketch")), "classes")

    def tables(rows):
        pairs = rows.select("id", "n", F.posexplode("left").alias("i", "a"), "right").select("id", "n", "i", "a", F.posexplode("right").alias("j", "b"))
        return pairs.select(F.xxhash64("i", "j", "a", "b").alias("key"), "id", "n")

    crowded = crowded_ranges(tables(classes.where(f"pmod(xxhash64(id), {SAMPLE}) = 0")))
    members = shared_members(tables(classes), "id", crowded)
    members = materialize(members.select("key", F.col("head.id").alias("head"), "id", "n"), "buckets")

    near = materialize(members.groupBy("id").agg(F.min("head").alias("head"), F.first("n").alias("n")), "candidates")
    texts = materialize(docs.join(small_or_not(near.select(F.col("id").alias("doc_id"))), "doc_id", "left_semi"), "texts")
    sizes = near.select("id", "n")

    def verified(pairs):
        """pairs: a, b, na, nb. Those whose full sets are similar enough, as u, v."""
        pairs = pairs.where(F.expr(f"a <> b and {den} * least(na, nb) >= {num} * greatest(na, nb)")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        joined = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
        return joined.mapInArrow(lambda it: _linked_batches(it, shingle, num, den), "u long, v long")

    def with_shared(left):
        """left with s, how many of a document's shingles any other open document has too.

        Two documents have min(sa, sb) shingles in common at most, so pairs and documents that
        cannot reach the similarity with that many are dropped before any pair is made.
        """
        ids = left.select(F.col("id").alias("doc_id"), "n").distinct()
        sets = texts.join(ids, "doc_id").select("doc_id", "text").mapInArrow(lambda it: _set_batches(it, shingle), "id long, shingles array<long>")
        each = sets.select("id", F.explode("shingles").alias("x"))
        common = each.groupBy("x").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo <> hi").select("x")
        s = each.join(common, "x", "left_semi").groupBy("id").agg(F.count("*").alias("s"))
        return left.join(s.join(classes.select("id", "sketch"), "id"), "id").where(f"{den} * s >= {num} * n")

    def possible(ga, gb, na, nb, sa, sb, ka, kb):
        differ = " + ".join(f"bit_count({ka}[{i}] ^ {kb}[{i}])" for i in range(SKETCH_BITS // 64))
        return F.expr(f"{ga} <> {gb} and {num} * ({na} + {nb}) <= {num + den} * least({sa}, {sb}) and {num + den} * ({differ}) <= {den - num} * ({na} + {nb})")

    first = near.join(sizes.select(F.col("id").alias("head"), F.col("n").alias("nb")), "head").select(F.col("id").alias("a"), F.col("head").alias("b"), F.col("n").alias("na"), "nb")
    links = materialize(verified(first), "verified")
    groups = components(links)

    def spanning(groups, name):
        """The rows of buckets that still hold different groups, with their group."""
        g = members.join(groups.withColumnRenamed("component", "g"), "id", "left").select("key", "id", "n", F.coalesce("g", "id").alias("g"))
        open_ = g.groupBy("key").agg(F.min("g").alias("lo"), F.max("g").alias("hi")).where("lo <> hi").select("key", "lo")
        return materialize(g.join(open_, "key"), name)

    left = spanning(groups, "open")
    done = [members, near, left, texts]
    if not left.isEmpty():
        left = materialize(with_shared(left), "bounded")
        done.append(left)
        pick = left.groupBy("key").agg(F.min_by(F.struct("id", "n", "g", "s", "sketch"), F.struct(F.xxhash64("id"), "id")).alias("p"))
        second = left.join(pick, "key").where(possible("g", "p.g", "n", "p.n", "s", "p.s", "sketch", "p.sketch")).select(F.col("id").alias("a"), F.col("p.id").alias("b"), F.col("n").alias("na"), F.col("p.n").alias("nb"))
        links = links.unionByName(materialize(verified(second), "verified"))
        groups = components(links)
        rest = spanning(groups, "open").join(left.select("id", "s").distinct(), "id")
        rest = materialize(rest.join(classes.select("id", "left", "right", "sketch"), "id"), "rest")
        done.append(rest)
        if not rest.isEmpty():
            main = rest.groupBy("key", "g").count().groupBy("key").agg(F.max_by("g", F.struct("count", "g")).alias("main"))
            light = rest.join(main, "key").where("g <> main").select("key", F.col("id").alias("a"), F.col("n").alias("na"), F.col("g").alias("ga"), F.col("s").alias("sa"), F.col("left").alias("la"), F.col("right").alias("ra"), F.col("sketch").alias("ka"))
            # a pair that meets in many tables is made in the first of them only
            at = lambda mine, theirs: f"cast(array_position(zip_with({mine}, {theirs}, (p, q) -> p = q), true) - 1 as int)"
            i, j = F.expr(at("la", "left")), F.expr(at("ra", "right"))
            table = F.xxhash64(i, j, F.get("la", i), F.get("ra", j))
            last = light.alias("x").join(rest.alias("y"), (F.col("x.key") == F.col("y.key")) & possible("ga", "g", "na", "n", "sa", "s", "ka", "sketch") & (table == F.col("x.key")))
            last = last.select("a", F.col("id").alias("b"), "na", F.col("n").alias("nb"))
            links = links.unionByName(materialize(verified(last), "verified"))
            groups = components(links)

    discard(*done)
    labels = classes.select("n", "h1", "h2", "id").join(groups, "id", "left").select("n", "h1", "h2", F.coalesce("component", "id").alias("component"))
    out = sig.select("doc_id", "n", "h1", "h2").join(labels, ["n", "h1", "h2"], "left")
    component = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("component")), F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near_dups(docs, **options):
    """docs with one row of each near-duplicate group, the first in the order of the table.

    Rows are judged by their text, whatever their id: rows that share an id are copies only if
    their texts are, and rows without an id are judged like others. All columns pass through.
    """
    spark = docs.sparkSession
    ship_package(spark)
    marked = materialize(docs.select(F.struct(*docs.columns).alias("doc"), F.monotonically_increasing_id().alias("row")), "near-dedup-rows")
    # a component's id is its least row, so no group is brought together to choose one
    found = near_dups(marked.select(F.col("row").alias("doc_id"), "doc.text"), **options)
    gone = materialize(found.where("doc_id <> component_id").select(F.col("doc_id").alias("row")), "gone")
    return marked.join(small_or_not(gone), "row", "left_anti").select("doc.*")

"""Source mixing to target weights on a low-discrepancy schedule, in DataFrame functions only.

Targets: the words of all sources are shared by weight; a target stops at `cap` times its
source's size and the excess is shared by weight again until none is above. Slot t of the
schedule is a golden-ratio point frac(t * phi), which falls into one source's range of the
cumulated targets; slots are ranked per source, and slot rank r of a source takes block r of its
documents, shuffled by hash and cut into blocks of equal word counts, the same at every table
size. After all blocks the documents come round again in the same order, `cap` times at most.
The points give a source its target to within a few blocks; its last blocks are then cut or added
so that it takes its target to the word, however small it is.

Ranks and running word counts are two-level prefix sums: sums per (source, bucket) first, then
windows inside small buckets, so a source with a third of all rows is never one window.

Null texts have size 0; null is a source of its own and comes last. Documents without words
are taken 0 times. An empty table gives an empty result. Rows that repeat an id count each.
"""

import math

from pyspark.sql import Window, functions as F

from quillon.session import materialize, ship_package

#: Fixed-point golden ratio, frac(phi) * 2**40, made odd.
PHI = 679_535_556_991
WEIGHTS = (5, 2, 1)
SPAN = 1 << 40
HALF = 1 << 20
#: Schedule point of slot t: frac(t * phi), multiplied in two halves so that nothing overflows.
POINT = f"(t div {HALF}L % {HALF}L * {PHI * HALF % SPAN}L + t % {HALF}L * {PHI}L) % {SPAN}L"
#: Words a block.
BLOCK = 16


def word_count(text):
    return F.coalesce(F.size(F.expr(f"filter(split({text}, '[ \\\\x09-\\\\x0D]+'), x -> x != '')")), F.lit(0)).cast("long")


def source_targets(sizes, weights=WEIGHTS, cap=3):
    """One row a source: source, source_size, target, lo, hi (its range of schedule points)."""
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(place) - 1) % len(weights) + 1).cast("int"))
    by = by.withColumn("weight", weight.cast("long")).withColumn("limit", F.col("source_size") * cap)
    full = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = full.rowsBetween(Window.unboundedPreceding, -1)
    after = full.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything)
    # sources in the order in which they reach their limits: those before are full, the rest share what is left
    share = F.when(F.sum("weight").over(after) > 0, (total - F.coalesce(F.sum("limit").over(earlier), F.lit(0))) * F.col("weight") / F.sum("weight").over(after))
    by = by.withColumn("share", share).withColumn("stops", F.col("limit") <= F.col("share"))
    open_ = F.min(F.when(~F.col("stops"), F.col("limit") / F.col("weight"))).over(everything)
    level = F.max(F.when((~F.col("stops")) & (F.col("limit") / F.col("weight") == open_), F.col("share") / F.col("weight"))).over(everything)
    by = by.withColumn("level", level)
    by = by.withColumn("target", F.when(F.col("stops"), F.col("limit").cast("double")).otherwise(F.col("level") * F.col("weight")))
    upto = place.rowsBetween(Window.unboundedPreceding, 0)
    edge = F.when(total > 0, F.round(F.sum("target").over(upto) / total * SPAN)).otherwise(0).cast("long")
    by = by.withColumn("hi", F.least(edge, F.lit(SPAN))).withColumn("lo", F.coalesce(F.lag("hi").over(place), F.lit(0)))
    return by.select("source", "source_size", "target", "lo", "hi", total.alias("total"))


def _running(df, parts, order, value, buckets):
    """df with `before`: the sum of value over earlier rows of its parts; buckets is the order's leading column."""
    sums = df.groupBy(*parts, buckets).agg(F.sum(value).alias("_sum"))
    prior = Window.partitionBy(*parts).orderBy(buckets).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*[F.col(c).alias(f"_{c}") for c in [*parts, buckets]], F.coalesce(F.sum("_sum").over(prior), F.lit(0)).alias("_prior"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*parts, buckets]]
    inside = Window.partitionBy(*parts, buckets).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    cond = same[0]
    for s in same[1:]:
        cond = cond & s
    return df.join(sums, cond).withColumn("before", F.col("_prior") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("_prior", *[f"_{c}" for c in [*parts, buckets]])


def shuffle_key():
    """A number below 2**60 that puts documents in their shuffled order."""
    named = F.concat_ws("-", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, 15), 16, 10).cast("long")


def mix(docs, weights=WEIGHTS, cap=3, block=BLOCK, row_key=None):
    """One row per document: doc_id, size, source, source_size, target, taken (words, repeats counted).

    row_key names a column that tells rows apart; it comes back under its own name.
    """
    spark = docs.sparkSession
    rid = F.col(row_key) if row_key else F.monotonically_increasing_id()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"), rid.alias("rid"))
    # rid only tells rows alike apart, once it is written
    sizes = materialize(docs.select("doc_id", "source", word_count("text").alias("size"), shuffle_key().alias("h"), "rid"), "sizes")
    # its single row of whole-table sums sets the number of slots and of buckets
    words, rows = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    n_slots = -(-words // block)
    end = F.least(F.round("target").cast("long"), F.col("source_size") * cap)
    targets = materialize(source_targets(sizes, weights, cap).withColumn("end", end), "targets")
    named = targets.select(F.col("source").alias("s"), "source_size", "target", "end")

    # schedule: slot t -> source -> rank among the source's slots; as many chunks as slots in one
    per = max(4096, math.isqrt(n_slots))
    points = spark.range(n_slots).withColumnRenamed("id", "t").select("t", F.expr(POINT).alias("u"), F.expr(f"t div {per}").alias("chunk"))
    # a point meets only the ranges of its cell, so no product of slots and sources is made
    cells = lambda c: F.expr(f"{c} div {SPAN >> 12}L")
    ranges = targets.where("hi > lo").select(F.col("source").alias("s"), "lo", "hi", F.explode(F.sequence(cells("lo"), cells("(hi - 1)"))).alias("cell"))
    slots_ = points.withColumn("cell", cells("u")).join(ranges, "cell").where("u >= lo and u < hi").select("t", "chunk", "s", F.lit(1).alias("one"))
    ranked = _running(slots_, ["s"], ["t"], "one", "chunk").select("s", F.col("before").alias("b"))
    # the points come within a few blocks of a target: too many are cut, missing ones are added
    last = targets.select(F.col("source").alias("z"), (-F.floor(-F.col("end") / block)).cast("long").alias("last"))
    ranked = ranked.join(F.broadcast(last), F.col("s").eqNullSafe(F.col("z"))).where("b < last").select("s", "b")
    number = slots_.groupBy("s").agg(F.count("*").alias("n"))
    short = last.join(number, F.col("z").eqNullSafe(F.col("s")), "left").where("coalesce(n, 0) < last")
    ranked = ranked.unionByName(short.select(F.col("z").alias("s"), F.explode(F.expr("sequence(coalesce(n, 0), last - 1)")).alias("b")))

    # blocks: documents in hash order, round and round up to the target, cut every `block` words
    some = -(-rows // max(256, math.isqrt(rows)))
    shuffled = sizes.where("size > 0").withColumn("bucket", F.expr(f"shiftright(h, 29) * {max(some, 1)}L div {1 << 31}L"))
    placed = _running(shuffled, ["source"], ["h", "doc_id", "rid"], "size", "bucket").join(named, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    turns = placed.select("rid", "source", "size", "end", F.explode(F.expr(f"transform(sequence(0, {cap - 1}), i -> i * source_size + before)")).alias("from"))
    turns = turns.where("`from` < end").withColumn("to", F.least(F.col("from") + F.col("size"), F.col("end")))
    parts = turns.withColumn("block", F.explode(F.expr(f"sequence(`from` div {block}L, (`to` - 1) div {block}L)")))
    parts = parts.select("rid", "source", "block", F.expr(f"least(`to`, (block + 1) * {block}L) - greatest(`from`, block * {block}L)").alias("part"))
    used = parts.join(ranked, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")), "left_semi")
    taken = used.groupBy("rid").agg(F.sum("part").alias("taken"))
    out = sizes.join(named, F.col("source").eqNullSafe(F.col("s"))).join(taken, "rid", "left")
    out = out.select("doc_id", "size", "source", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), *([F.col("rid").alias(row_key)] if row_key else []))
    return out


def apply_mix(docs, **options):
    """docs with each row as often as the mix takes its words, rounded to whole times."""
    spark = docs.sparkSession
    ship_package(spark)
    marked = materialize(docs.select(F.struct(*docs.columns).alias("doc"), F.monotonically_increasing_id().alias("row")), "mix-rows")
    taken = mix(marked.select("doc.doc_id", "doc.source", "doc.text", "row"), row_key="row", **options)
    copies = taken.where("size > 0").select("row", F.expr("(2 * taken + size) div (2 * size)").alias("copies")).where("copies > 0")
    return marked.join(copies, "row").select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")


def oracle():
    """DuckDB SQL for mix over documents: a source's documents are taken in shuffled order up to its target."""
    return f"""
WITH d AS (SELECT doc_id, source, text, CAST(coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\x0B\\f\\r]+')), 0) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '-' || coalesce(text, '')), 1, 15) AS BIGINT) AS h FROM documents),
by_ AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
w AS (SELECT *, 3 * source_size AS lim, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, CAST(sum(source_size) OVER () AS BIGINT) AS total FROM by_),
f AS (SELECT *, CAST(coalesce(sum(lim) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS full_, CAST(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS open_ FROM w WINDOW o AS (ORDER BY lim / weight, source NULLS LAST)),
g AS (SELECT *, (total - full_) * weight / open_ AS share FROM f),
k AS (SELECT min(lim / weight) AS first_ FROM g WHERE lim > share),
v AS (SELECT max(share / weight) AS level FROM g, k WHERE lim > share AND lim / weight = first_),
t AS (SELECT source, source_size, total, CASE WHEN lim <= share THEN CAST(lim AS DOUBLE) ELSE level * weight END AS target FROM g LEFT JOIN v ON true),
n AS (SELECT source, source_size, target, least(CAST(round(target) AS BIGINT), 3 * source_size) AS words FROM t),
s AS (SELECT d.*, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY h, doc_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM d)
SELECT doc_id, size, source_size, target,
    CAST({' + '.join(f"greatest(0, least({i} * source_size + before + size, words) - ({i} * source_size + before))" for i in range(3))} AS BIGINT) AS taken
FROM s JOIN n ON s.source IS NOT DISTINCT FROM n.source"""

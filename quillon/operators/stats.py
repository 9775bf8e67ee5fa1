"""Position, distance and overlap statistics of sequence sets."""

from pyspark.sql import Window, functions as F


def positions(rows, seq="aa_seq", keep=()):
    """One row a residue: keep, pos (0-based), aa."""
    return rows.select(*keep, F.posexplode(F.split(seq, "")).alias("pos", "aa"))


def group_starts(rows, order, value, partition):
    """Adds starts: whether a row's value is another than that of the row before."""
    w = Window.partitionBy(*partition).orderBy(order)
    return rows.withColumn("starts", ~F.col(value).eqNullSafe(F.lag(value).over(w)) | (F.row_number().over(w) == 1))


def position_matrix(rows, seq="aa_seq"):
    """pos, aa, n, share of the position."""
    g = positions(rows, seq).groupBy("pos", "aa").agg(F.count("*").alias("n"))
    return g.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("pos")))


def position_log_odds(rows, label="specificity", eps=1e-4):
    """pos, aa, log2 of the share among label 1 over the share among the rest."""
    g = positions(rows, keep=(label,)).groupBy("pos", "aa").agg(F.count_if(F.col(label) == 1).alias("a"), F.count_if(F.col(label) != 1).alias("b"))
    own = Window.partitionBy("pos")
    share = lambda c: F.coalesce(F.try_divide(F.col(c).cast("double"), F.sum(c).over(own)), F.lit(0.0))
    return g.withColumn("pa", share("a")).withColumn("pb", share("b")).select("pos", "aa", F.log2((F.col("pa") + eps) / (F.col("pb") + eps)).alias("log_odds"))


def mutual_information(rows, reach, seq="aa_seq"):
    """i, j, mi in nats of residue pairs at most reach apart; pairs come from each row's own array."""
    s = rows.select(F.split(seq, "").alias("s"))
    pairs = s.select("s", F.posexplode("s").alias("i", "a")).select("i", "a", F.posexplode(F.slice("s", F.col("i") + 2, reach)).alias("k", "b")).select("i", (F.col("i") + F.col("k") + 1).alias("j"), "a", "b")
    joint = pairs.groupBy("i", "j", "a", "b").agg(F.count("*").alias("n"))
    over = lambda *c: F.sum("n").over(Window.partitionBy(*c))
    joint = joint.withColumn("t", over("i", "j")).withColumn("na", over("i", "j", "a")).withColumn("nb", over("i", "j", "b"))
    return joint.groupBy("i", "j").agg(F.sum(F.col("n") / F.col("t") * F.ln(F.col("n") * F.col("t") / (F.col("na") * F.col("nb")))).alias("mi"))


def pair_enrichment(rows, i, j, label="specificity", eps=1e-6):
    """Residue pairs at (i, j) seen in positives: shares and their ratio."""
    p = rows.select(label, F.substr("aa_seq", F.lit(i + 1), F.lit(1)).alias("a"), F.substr("aa_seq", F.lit(j + 1), F.lit(1)).alias("b"))
    g = p.groupBy("a", "b").agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    every = Window.partitionBy()
    g = g.withColumn("tp", F.sum("pos").over(every)).withColumn("tn", F.sum("neg").over(every)).where("pos > 0")
    share = lambda c, t: F.coalesce(F.try_divide(F.col(c).cast("double"), F.col(t)), F.lit(0.0))
    return g.select("a", "b", "pos", "neg", ((share("pos", "tp") + eps) / (share("neg", "tn") + eps)).alias("enrichment"))


def gapped_motifs(rows, gap=2, tile=4, seq="aa_seq"):
    """tile, start, gap, a, b, n of residue pairs within a tile."""
    s = rows.select(F.split(seq, "").alias("s")).select("s", F.posexplode("s").alias("i", "a"))
    p = s.select("i", "a", F.posexplode(F.slice("s", F.col("i") + 2, gap + 1)).alias("gap", "b"))
    p = p.withColumn("tile", F.floor(F.col("i") / tile)).where(F.floor((F.col("i") + F.col("gap") + 1) / tile) == F.col("tile"))
    return p.groupBy("tile", F.col("i").alias("start"), "gap", "a", "b").agg(F.count("*").alias("n"))


def dense_counts(rows, letters, length, label="specificity", seq="aa_seq"):
    """pos, aa, a, b: rows of label 1 and 0 with each letter at each position, 0 where there are none."""
    p = positions(rows, seq, keep=(label,))
    g = p.groupBy("pos", "aa").agg(F.count_if(F.col(label) == 1).alias("a"), F.count_if(F.col(label) == 0).alias("b"))
    grid = rows.sparkSession.range(length).select(F.col("id").cast("int").alias("pos"), F.explode(F.split(F.lit(letters), "")).alias("aa"))
    return grid.join(g, ["pos", "aa"], "left").na.fill(0, ["a", "b"])


def top_residue(rows, letters, label="specificity", pseudo=1, length=11):
    """The most enriched residue of each position by log ratio of counts; ties go to the earlier letter."""
    g = dense_counts(rows, letters, length, label)
    g = g.withColumn("r", F.round(F.ln((F.col("a") + pseudo) / (F.col("b") + pseudo)), 9)).withColumn("k", -F.instr(F.lit(letters), F.col("aa")))
    return g.groupBy("pos").agg(F.max_by("aa", F.struct("r", "k")).alias("aa"), F.max("r").alias("log_ratio"))


def tile_log_odds(rows, letters, length, first=1, size=4, pseudo=1, label="specificity"):
    """tile, pos, place (1-based in its tile), aa, log_odds: natural log of the shares of label 1 and 0 at each position of sliding tiles."""
    g = dense_counts(rows, letters, length, label).withColumns({c: F.col(c) + pseudo for c in ("a", "b")})
    own = Window.partitionBy("pos")
    odds = F.ln((F.col("a") / F.sum("a").over(own)) / (F.col("b") / F.sum("b").over(own)))
    g = g.select("pos", "aa", odds.alias("log_odds"))
    tiles = rows.sparkSession.range(first, length - size + 1).select((F.col("id") - first).alias("tile"), F.explode(F.sequence(F.col("id"), F.col("id") + size - 1)).alias("pos"), F.col("id").alias("_from"))
    return g.join(F.broadcast(tiles), "pos").select("tile", "pos", (F.col("pos") - F.col("_from") + 1).alias("place"), "aa", "log_odds")


def cooccurrence(rows, anchor_pos, anchor_aa, reach=3, least=0, top_only=False, following=False):
    """pos, aa, n, share around an anchor residue, among rows that have it.

    Positions with fewer than `least` rows are left out; top_only keeps each one's commonest
    residue, the first by letter among equals; following keeps positions behind the anchor.
    """
    own = rows.where(F.substr("aa_seq", F.lit(anchor_pos + 1), F.lit(1)) == anchor_aa)
    d = F.col("pos") - anchor_pos
    m = position_matrix(own).where(d.between(1, reach) if following else F.abs(d).between(1, reach))
    if least:
        m = m.withColumn("_n", F.sum("n").over(Window.partitionBy("pos"))).where(F.col("_n") >= least).drop("_n")
    if top_only:
        m = m.withColumn("_k", F.row_number().over(Window.partitionBy("pos").orderBy(F.desc("n"), "aa"))).where("_k = 1").drop("_k")
    return m


def commonest_residue(rows, seq="aa_seq"):
    """One row: the residue that occurs most, the first by letter among equals, its number, and the first position that has it."""
    g = positions(rows, seq).groupBy("aa").agg(F.count("*").alias("n"), F.min("pos").alias("first_pos"))
    return g.orderBy(F.desc("n"), "aa").limit(1)


def top_per_group(rows, group, order, k):
    """The first k rows of each group in an order."""
    return rows.withColumn("_k", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("_k") <= k).drop("_k")


def distance_histogram(rows, reference, seq="aa_seq"):
    """distance, n of distinct sequences by edit distance to a reference."""
    return rows.select(seq).distinct().groupBy(F.levenshtein(seq, F.lit(reference)).cast("long").alias("distance")).agg(F.count("*").alias("n"))


def fixed_length(rows, seq="aa_seq"):
    """rows, checked as they are read: a sequence of another length than the first by order raises."""
    length = rows.agg(F.min(F.length(seq)).alias("_length"))
    same = F.assert_true(F.length(seq) == F.col("_length"), F.lit("sequences differ in length"))
    return rows.join(F.broadcast(length)).where(same.isNull()).select(rows.columns)


def sequence_length_check(rows, seq="aa_seq"):
    """One row: how many lengths the sequences have, and whether it is one."""
    return rows.agg(F.count_distinct(F.length(seq)).alias("n_lengths")).withColumn("fixed", F.col("n_lengths") == 1)


def within_edits(reference, query, most, tiled=False):
    """Whether a sequence is at most so many edits from the reference and, tiled, all of them in a span of `most` of its letters.

    Edits are those of difflib's matching blocks, which only sequences within the distance reach.
    """
    near = F.levenshtein(F.lit(reference), F.col(query)) <= most
    if not tiled:
        return near

    @F.pandas_udf("boolean")
    def inside(s):
        import difflib

        def span(q):
            cuts = [(i, j) for tag, i, j, _, _ in difflib.SequenceMatcher(None, reference, q).get_opcodes() if tag != "equal"]
            return not cuts or max(j for _, j in cuts) - min(i for i, _ in cuts) <= most

        return s.map(lambda q: None if q is None else span(q)).astype("boolean")

    return F.when(near, inside(F.when(near, F.col(query)))).otherwise(near)


def finite(c):
    """A number, 0 where it is null, infinite or not a number."""
    c = F.col(c) if isinstance(c, str) else c
    bad = c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return F.when(bad, 0.0).otherwise(c)


def distance_bins(rows, reference, count="n"):
    """Counts by edit distance to a reference: 0 to 4, and 4+ for more."""
    d = F.levenshtein("aa_seq", F.lit(reference))
    return rows.groupBy(F.when(d >= 5, "4+").otherwise(d.cast("string")).alias("bin")).agg(F.sum(count).alias("n"), F.count("*").alias("n_variants"))


def frequent(rows, value, least):
    """The rows whose value occurs `least` times or more."""
    often = rows.groupBy(value).count().where(F.col("count") >= least).select(value)
    return rows.join(often, value, "left_semi").select(rows.columns)


def consecutive_collapse(rows, order, value, partition, least=1):
    """Rows whose value differs from the row before, in order within their partition; first those of values seen less than `least` times go.

    A partition is one task's, so it must be a column or more.
    """
    if not partition:
        raise ValueError("give the columns within which rows follow each other")
    rows = rows if least <= 1 else frequent(rows, value, least)
    w = Window.partitionBy(*partition).orderBy(order)
    return rows.withColumn("_before", F.lag(value).over(w)).where(~F.col(value).eqNullSafe(F.col("_before"))).drop("_before")


def spearman(rows, x, y, group):
    """Rank correlation within groups, ties at their average rank."""
    for c in (x, y):
        w = Window.partitionBy(group)
        rows = rows.withColumn(f"_{c}", F.rank().over(w.orderBy(c)) + (F.count("*").over(Window.partitionBy(group, c)) - 1) / 2)
    return rows.groupBy(group).agg(F.corr(f"_{x}", f"_{y}").alias("rho"), F.count("*").alias("n"))


def describe(rows, group, value):
    q = lambda p: F.percentile(value, F.lit(p))
    return rows.groupBy(group).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"), F.min(value).alias("min"), q(0.25).alias("q1"), q(0.5).alias("q2"), q(0.75).alias("q3"), F.max(value).alias("max"))

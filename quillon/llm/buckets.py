"""Buckets of rows with equal keys, dealt so that a crowded key is never one task's."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

#: Keys are counted by so many hash ranges; a range is crowded with more rows than a fair partition holds.
RANGES = 1 << 16


def parts(spark):
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)


def _range(key):
    return F.expr(f"pmod(xxhash64({key}), {RANGES})")


def crowded_ranges(sample, key="key"):
    """Hash ranges that hold more of the sampled rows than one of the session's partitions should.

    There are fewer of them than partitions, so the list is small. It only decides how rows are
    dealt, not what comes out, so a sample of the rows will do.
    """
    n = parts(sample.sparkSession)
    # one row a range, so that the sample is read once
    counted = sample.groupBy(_range(key).alias("r")).agg(F.count("*").alias("n")).toArrow()
    size = counted.column("n").to_numpy()
    return sorted(counted.column("r").to_numpy()[size > max(size.sum() / n, 100)].tolist())


def whole_groups(batches):
    """The columns of batches sorted by their first one, as rows of an array, so that no group of it is cut."""
    held = []
    for batch in batches:
        if batch.num_rows:
            now = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            cut = np.searchsorted(now[0], now[0, -1])
            if held and (cut or held[-1][0, -1] != now[0, 0]):
                same = np.searchsorted(now[0], held[-1][0, -1], "right")
                held.append(now[:, :same])
                yield np.concatenate(held, 1)
                held, now = [], now[:, same:]
                cut = np.searchsorted(now[0], now[0, -1]) if now.shape[1] else 0
            if cut:
                yield now[:, :cut]
            if now.shape[1] > cut:
                held.append(now[:, cut:])
    if held:
        yield np.concatenate(held, 1)


def _shared_batches(batches, names):
    """Rows (key, doc, the rest) of keys that two or more docs have, with the least row of each key."""
    for rows in whole_groups(batches):
        start = np.flatnonzero(np.concatenate(([True], rows[0, 1:] != rows[0, :-1])))
        size = np.diff(np.append(start, rows.shape[1]))
        rows = rows[:, np.repeat(np.minimum.reduceat(rows[1], start) != np.maximum.reduceat(rows[1], start), size)]
        if rows.shape[1]:
            rows = rows[:, np.lexsort(rows[::-1])]
            new = np.concatenate(([True], rows[0, 1:] != rows[0, :-1]))
            least = rows[1:, np.flatnonzero(new)[np.cumsum(new) - 1]]
            head = pa.StructArray.from_arrays([pa.array(c) for c in least], names[1:])
            yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in rows), head], [*names, "head"])


def shared_members(rows, doc, crowded, key="key", stream=False):
    """rows of keys that two or more docs have, each beside `head`, the least row (by doc, then the rest) of its key. All columns are longs.

    Rows are dealt by key in one shuffle that the aggregates and the join all read; or, with stream
    and no crowded range, it is sorted and read once, in Python workers beside the executor. Rows of
    crowded ranges are dealt by key and salt: each salt finds its least row, these are brought
    together by key, one row a salt, and every salt joins its own rows with the outcome.
    """
    rest = [doc, *[c for c in rows.columns if c not in (key, doc)]]
    rows = rows.select(*[F.coalesce(c, F.lit(0)).alias(c) for c in [key, *rest]])
    if not crowded and stream:
        names = [key, *rest]
        longs = lambda names, sep: ", ".join(f"{n}{sep} long" for n in names)
        schema = f"{longs(names, '')}, head struct<{longs(rest, ':')}>"
        return rows.repartition(key).sortWithinPartitions(key).mapInArrow(lambda it: _shared_batches(it, names), schema)
    if not crowded:
        dealt = rows.repartition(key)
        part = dealt.groupBy(key).agg(F.min(F.struct(*rest)).alias("head"), F.max(doc).alias("most"))
        return dealt.join(part.where(F.col(f"head.{doc}") != F.col("most")).drop("most"), key)
    hot = _range(key).isin(crowded)
    salt = F.when(hot, F.expr(f"pmod(xxhash64({', '.join(rest)}), {parts(rows.sparkSession)})")).otherwise(-1).cast("int")
    dealt = rows.withColumn("salt", salt).repartition(key, "salt")
    # every branch below uses all columns and no filter that could move below the shuffle, so it is made once
    part = dealt.groupBy(key, "salt").agg(F.min(F.struct(*rest)).alias("head"), F.max(doc).alias("most"), F.max("salt").alias("of"))
    salted = part.where("of >= 0")
    whole = salted.groupBy(key).agg(F.min("head").alias("h"), F.max("most").alias("m"))
    salted = salted.join(whole, key).select(key, "salt", F.least("head", "h").alias("head"), F.greatest("most", "m").alias("most"))
    part = part.where("of < 0").drop("of").unionByName(salted)
    return dealt.join(part.where(F.col(f"head.{doc}") != F.col("most")).drop("most"), [key, "salt"]).drop("salt")

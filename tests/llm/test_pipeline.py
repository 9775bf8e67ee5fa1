"""The pipeline against a plain version of its five stages, row by row."""

import collections
import hashlib
import re
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from quillon.llm import decontaminate, quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(t):
    w = [x.lower() for x in (t or "").encode().split()]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_dedup(rows):
    """Groups of indices: components of texts that share 4 of 5 shingles."""
    sets, parent = [shingles(r[1]) for r in rows], list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a & b and 100 * len(a & b) >= 80 * len(a | b):
                parent[top(i)] = top(j)
    groups = collections.defaultdict(list)
    for i in range(len(rows)):
        groups[top(i)].append(i)
    return groups.values()


def has_item(text, items):
    words = re.findall(r"[a-z0-9\u0080-\uffff]+", (text or "").lower())
    for item in items:
        k, row = decontaminate.budget(len(item), 0.1, 5), list(range(len(item) + 1))
        best = row[-1]
        for w in words:
            new = [0]
            for i, x in enumerate(item, 1):
                new.append(min(row[i - 1] + (x != w), row[i] + 1, new[i - 1] + 1))
            row = new
            best = min(best, row[-1])
        if best <= k:
            return True
    return False


def brute_mix(rows):
    """(doc_id, text) as often as the mix takes each."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    total = collections.Counter()
    for r, n in zip(rows, size):
        total[r[3]] += n
    names = sorted(s for s in total if s is not None) + [None] * (None in total)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full = set()
    while True:
        left = sum(total.values()) - sum(3 * total[s] for s in full)
        target = {s: 3 * total[s] if s in full else left * weight[s] / sum(weight[o] for o in names if o not in full) for s in names}
        over = {s for s in names if s not in full and target[s] >= 3 * total[s]}
        if not over:
            break
        full |= over
    out, before = [], collections.Counter()
    key = lambda i: (int(hashlib.md5(f"{'' if rows[i][0] is None else rows[i][0]}-{rows[i][1] or ''}".encode()).hexdigest()[:15], 16), rows[i][0] is not None, rows[i][0])
    for i in sorted(range(len(rows)), key=key):
        s, n = rows[i][3], size[i]
        end = min(int(target[s] + 0.5), 3 * total[s])
        taken = sum(max(0, min(turn * total[s] + before[s] + n, end) - turn * total[s] - before[s]) for turn in range(3))
        before[s] += n
        out += [(rows[i][0], rows[i][1])] * ((2 * taken + n) // (2 * n) if n else 0)
    return out


def brute_tokens(rows):
    from tokenizers import Tokenizer

    tok, at, out = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def table():
    rng = np.random.default_rng(6)
    words = [f"word{i}" for i in range(300)]
    say = lambda n: " ".join(rng.choice(words, n)) + "."
    items = [[f"Item{i}x{j}" for j in range(30)] for i in range(3)]
    rows = []
    for i in range(90):
        t = say(int(rng.integers(20, 120)))
        if i % 9 == 4:
            t = " ".join(f"{w.upper()}!!" for w in t.split())
        if i % 13 == 5:
            t += " " + " ".join([*items[i % 3][:11], "Edited", *items[i % 3][12:]]) + " " + say(5)
        rows.append((i, t, "en", ["a", "b", "c", None][i % 4], 1))
    copies = [(100 + i, rows[i][1] if i % 2 else rows[i][1] + " more words here", "en", "a", 1) for i in range(0, 40, 3)]
    odd = [(7, say(40), "de", "b", 1), (7, say(30), "de", "b", 2), (8, rows[8][1], "en", "a", 1), (None, say(25), "en", "c", 1), (None, rows[10][1], None, "c", 1), (200, None, "en", "a", 1), (201, "", "en", None, 0), (202, " ".join(words) * 20, "en", "c", 1)]
    labels = [(i, int(i % 9 != 4)) for i in range(90)] + [(3, None)]
    return rows + copies + odd, labels, [(i, " ".join(x)) for i, x in enumerate(items)] + [(9, None), (10, "")]


def written(spark, where, rows, labels, items):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    return str(where)


def test_run_equals_brute_force(spark, tmp_path):
    rows, labels, items = table()
    sf = written(spark, tmp_path / "sf", rows, labels, items)
    model = quality.fit(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    # as the table has them, since of each group its first row stays
    rows = [tuple(r)[:5] for r in sorted(spark.read.parquet(f"{sf}/documents.parquet").withColumn("row", F.monotonically_increasing_id()).collect(), key=lambda r: r.row)]
    scores = model.scores(pa.array([r[1] for r in rows]))
    kept = [r for r, s in zip(rows, scores) if s >= 0.3]
    assert 0 < len(rows) - len(kept) < 30
    groups = [[kept[i] for i in g] for g in brute_dedup(kept)]
    assert len(groups) < len(kept)
    kept = [g[0] for g in groups]
    clean = [r for r in kept if not has_item(r[1], [re.findall("[a-z0-9]+", t.lower()) for _, t in items if t])]
    assert len(clean) < len(kept)
    assert 202 in {r[0] for r in clean} and sum(r[0] == 7 for r in clean) >= 2
    expect = brute_tokens(brute_mix(clean))
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).collect()), key=lambda r: r[1]) == expect


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)] * 3, [(1, "", "en", "a", 0), (1, " \n", "en", "a", 0)], [(1, "one two three", "en", None, 1)] * 2])
def test_empty_and_null_tables(spark, tmp_path, rows):
    sf = written(spark, tmp_path / "sf", rows, [], [])
    got = corpus_pipeline.run(spark, sf).collect()
    # without labels all stay; without words the mix takes nothing; equal rows are copies, and one word source takes what it has
    assert len(got) == (1 if rows and rows[0][1] == "one two three" else 0)


def test_stages_keep_columns(spark, tmp_path):
    rows, labels, items = table()
    sf = written(spark, tmp_path / "sf", rows, labels, items)
    docs = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("*", "1 AS row", "2 AS g", "'x' AS score", "3 AS size")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        assert name == "mixing" or out.count() <= docs.count()

"""Operators of the training-data subpackage against brute force on small, awkward tables."""

import collections
import hashlib
import re
import tracemalloc
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from quillon.llm import buckets, decontaminate, language, mixing, near_dedup, perplexity, quality, queries, secrets, substring_dedup, token_files, url_filter, words as W

TOK = public_tokenizers.path("byte_bpe_50k.json")


def split(t):
    return (t or "").encode().split()


def brute_groups(rows, k, num=80, den=100):
    sets = {}
    for d, t in rows:
        w = [x.lower() for x in split(t)]
        sets.setdefault(d, []).append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and any((i := len(x & y)) and den * i >= num * (len(x) + len(y) - i) for x in sets[a] for y in sets[b]):
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {d: top(d) for d in sets}


@pytest.mark.parametrize("k", [2, 5])
def test_near_dups(docs, k):
    got = near_dedup.near_dups(docs, shingle=k).collect()
    assert len(got) == docs.count()
    expect = brute_groups([(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None and r.text != "repeated id"], k)
    for r in got:
        if r.doc_id == 3 and r.component_id == 3:  # the row that repeats the id
            continue
        assert r.component_id == (expect[r.doc_id] if r.doc_id is not None else None)
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)


def test_near_dups_with_a_hub(spark):
    """A large group of near copies, with members that only some others link to."""
    rng = np.random.default_rng(3)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for d in range(150):
        t = list(base)
        for i in rng.choice(100, rng.integers(0, 9), replace=False):
            t[i] = f"n{d}_{i}"
        rows.append((d, " ".join(t)))
    got = near_dedup.near_dups(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2).collect()
    expect = brute_groups(rows, 2)
    assert {r.doc_id: r.component_id for r in got} == expect


def test_near_copies_make_few_links(spark, monkeypatch):
    """Near copies whose first ones are too far from all others: a few links a document, no group lost."""
    from quillon.llm import components as C

    rng, rows = np.random.default_rng(5), []
    for d in range(240):
        t = [f"w{j}" for j in range(400)]
        for j in rng.choice(400, 12 if d < 3 else 4, replace=False):
            t[j] = f"e{d}x{j}"
        rows.append((d, " ".join(t)))
    links = []

    def counting(df, name, written=near_dedup.materialize):
        out = written(df, name)
        if name == "links":
            links.append(out.count())
        return out

    monkeypatch.setattr(C, "materialize", counting)
    got = near_dedup.near_dups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_groups(rows, 5)
    assert max(links) <= 12 * len(rows)


def test_sketches_bound_the_difference():
    """Two parity sketches never differ in more bits than the sets differ in shingles."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 60, n)) for n in (0, 1, 2, 30, 31, 300, 3000)] * 2
    texts += [texts[5] + " more", texts[5].replace("w7 ", ""), None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    (out,) = near_dedup.signature_batches([batch], 2, 2, 1)
    sketch = [np.array(x, np.int64).view(np.uint64) for x in out.column("sketch").to_pylist()]
    (c,) = W.chunks(batch.column("text"))
    sets = [set(x.tolist()) for x in W.shingle_sets(c, 2)]
    for a in range(len(texts)):
        for b in range(a):
            differ = int(np.bitwise_count(sketch[a] ^ sketch[b]).sum())
            assert differ <= len(sets[a] ^ sets[b]) and (differ - len(sets[a] ^ sets[b])) % 2 == 0


def test_empty_tables(spark, empty):
    assert near_dedup.near_dups(empty).count() == 0
    assert perplexity.judge(empty).count() == 0
    assert token_files.read_token_files(token_files.write_token_files(empty, TOK)).count() == 0
    assert mixing.mix(empty).count() == 0 and mixing.apply_mix(empty).count() == 0
    assert secrets.scan(empty).count() == 0
    assert substring_dedup.repeated_passages(empty).count() == 0
    assert language.predict(empty, language.fit(empty)).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.score(empty, quality.fit(empty, labels)).count() == 0
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_items(empty, bench).count() == 0


def test_perplexity_base_columns(docs):
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id not in (3, None)}
    got = perplexity.judge(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id in texts:
            t = texts[r.doc_id] or ""
            w = re.findall(r"[^\x20\x09-\x0D]+", t)
            g = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
            n = collections.Counter(g)
            again = {j for i, x in enumerate(g) if n[x] > 1 for j in range(i, i + 5)}
            lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again))
            assert r.base_failed == (len(w) < 10 or 100 * len(again) > 20 * len(w)) and not (r.kept and r.base_failed)
            assert (r.perplexity is None) == (len(w) == 0)


class BruteKneserNey:
    """Interpolated modified Kneser-Ney over byte strings, by the definition, with dictionaries."""

    def __init__(self, counts, order):
        self.tables = {order: dict(counts)}
        for n in range(order - 1, 0, -1):
            left = collections.defaultdict(set)
            for g in self.tables[n + 1]:
                left[g[1:]].add(g[0])
            self.tables[n] = {g: len(x) for g, x in left.items()}
        self.cuts, self.after = {}, {}
        for n, t in self.tables.items():
            c = collections.Counter(t.values())
            y = c[1] / (c[1] + 2 * c[2]) if c[1] + c[2] else 0.5
            self.cuts[n] = [0] + [min(max(i - (i + 1) * y * c[i + 1] / c[i] if c[i] else 0.75, 0.05), i - 0.05) for i in (1, 2, 3)]
            self.after[n] = collections.defaultdict(list)
            for g, k in t.items():
                self.after[n][g[:-1]].append(k)

    def p(self, g):
        if not g:
            return 1 / 256
        n, cut = len(g), self.cuts[len(g)]
        seen, c = self.after[n].get(g[:-1], []), self.tables[n].get(g, 0)
        if not seen:
            return self.p(g[1:])
        return (c - cut[min(c, 3)] + sum(cut[min(k, 3)] for k in seen) * self.p(g[1:])) / sum(seen)


def test_perplexity_equals_brute_force(spark):
    """Scores of a small corpus from the definition; the model's probabilities sum to 1, unseen bytes included."""
    rng = np.random.default_rng(4)
    vocabulary = ["the", "cat", "sat", "on", "a", "mat", "été", "runs", "far", "away", "and", "then", "sleeps"]
    rows = [(i, "en" if i % 3 else "fr", " ".join(rng.choice(vocabulary, int(rng.integers(8, 30))))) for i in range(60)]
    rows += [(100, "en", "odd text"), (101, None, "the cat sat on a mat and then runs far away"), (102, "en", "new " * 12)]
    counts, judged = {}, {}
    for d, lang, t in rows:
        (c,) = W.chunks(pa.array([t]), lower=False)
        fold = perplexity.folds(c, np.zeros(len(c.hashes), np.int64))
        run, base = b" " * 5, perplexity.base_columns(c)
        for w, f in zip(t.encode().split(), fold.tolist()):
            for byte in w + b" ":
                run += bytes([byte])
                judged.setdefault(d, []).append((lang, f, run[-6:]))
                if not perplexity.fails(base)[0]:
                    counts.setdefault((lang, f), collections.Counter())[run[-6:]] += 1
    models = {k: BruteKneserNey(c, 6) for k, c in counts.items()}
    none = BruteKneserNey({}, 6)
    got = {r.doc_id: r.perplexity for r in perplexity.judge(spark.createDataFrame(rows, "doc_id long, lang string, text string")).collect()}
    for d, strings in judged.items():
        level = -sum(np.log(models.get((lang, 1 - f), none).p(g)) for lang, f, g in strings) / len(strings)
        assert got[d] == pytest.approx(np.exp(level), rel=1e-4), d
    for m in models.values():
        for h in (b"he ca", b" the ", b"zzzzz", b"     "):
            assert sum(m.p(h + bytes([x])) for x in range(256)) == pytest.approx(1)


def test_perplexity_band_rejects_both_sides(spark):
    """Keyboard noise is above the band and text of the commonest words below it; ordinary texts stay."""
    rng = np.random.default_rng(8)
    syllables = [a + b for a in "bdfgklmnprst" for b in "aeiou"]
    vocabulary = ["".join(rng.choice(syllables, rng.integers(1, 5))) for _ in range(800)]
    weight = 1 / np.arange(1, 801)
    say = lambda n: " ".join(rng.choice(vocabulary, n, p=weight / weight.sum()))
    rows = [(i, "en", say(int(rng.integers(64, 120)))) for i in range(400)]
    rows += [(1000 + i, "en", " ".join("".join(rng.choice(list("qxzjvwkq"), 6)) for _ in range(80))) for i in range(5)]
    rows += [(2000 + i, "en", " ".join(rng.choice(vocabulary[:12], 80))) for i in range(5)]
    got = {r.doc_id: r for r in perplexity.judge(spark.createDataFrame(rows, "doc_id long, lang string, text string")).collect()}
    assert sum(got[i].kept for i in range(400)) >= 380
    assert not any(got[d + i].kept for d in (1000, 2000) for i in range(5))
    # by the band, not by the base rules
    assert not any(got[2000 + i].base_failed for i in range(5))


def test_strings_are_sorted_once_a_chunk(monkeypatch):
    """Distinct keys and counts equal the plain ones, without a sort of places: keys equal but for their last bits, many languages."""
    rng = np.random.default_rng(4)
    near = (np.int64(7) << 40) + rng.integers(0, 9, 50)
    for keys in (rng.integers(-(1 << 63), 1 << 63, 3000), rng.integers(-5, 5, 300) << 50, np.concatenate((near, -near)), np.zeros(0, np.int64)):
        k, order, at = perplexity.distinct(keys)
        assert k.tolist() == sorted(set(keys.tolist())) and np.array_equal(k[at], keys[order]) and sorted(order.tolist()) == list(range(len(keys)))
    texts = [" ".join(rng.choice(["a", "bb", "caf\u00e9"], int(rng.integers(0, 30)))) for _ in range(200)]
    langs = [["en", "de", ""][i % 3] for i in range(200)]
    expect = {}
    for c in W.chunks(pa.array(texts), lower=False):
        (g, row, fold), good = perplexity.strings(c), ~perplexity.fails(perplexity.base_columns(c))
        for x, r, f in zip(g.tolist(), row.tolist(), fold.tolist()):
            expect.setdefault((langs[c.lo + r], x), [0, 0])[f] += int(good[r])
    batch = pa.RecordBatch.from_arrays([pa.array(langs), pa.array(texts)], ["lang", "text"])
    for limit in (perplexity.NAMES, 0):
        monkeypatch.setattr(perplexity, "NAMES", limit)
        got = {}
        for b in perplexity._count_batches([batch]):
            for r in b.to_pylist():
                n = got.setdefault((r["lang"], r["g"]), [0, 0])
                n[0], n[1] = n[0] + r["c0"], n[1] + r["c1"]
        assert got == expect


def test_token_files_round_trip(docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(TOK)
    rows = sorted(((r.doc_id is not None, r.doc_id, r.text is not None, r.text) for r in docs.collect()), key=lambda r: (r[0], r[1] or 0, r[2], r[3] or ""))
    at, expect = 0, []
    for _, d, _, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        expect.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = token_files.read_token_files(token_files.write_token_files(docs, TOK, partitions=3)).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expect


def test_words_of_letters_go_to_the_merges():
    """Only the first word, marks and words that are not Latin letters are cut by the tokenizer; the ids are its own."""
    cache, asked = token_files.PieceCache(TOK), []

    class Asked:
        def __getattr__(self, name):
            if name == "model":
                return tok.model

            def call(text, **more):
                asked.extend([text] if isinstance(text, str) else text)
                return getattr(tok, name)(text, **more)

            return call

    tok, cache.tokenizer = cache.tokenizer, Asked()
    text = "Erste \u00dcbung, \u00e9t\u00e9!\n\u00d1ame \u0111\u00e0 plain\nwords? words 12 \u03b1\u03b2 \u6f22\u5b57 x\u02b0"
    ids = np.array(tok.encode(text, add_special_tokens=False).ids, cache.kind).tobytes()
    assert cache.encode(text) == cache.encode(text) == ids
    assert sorted(asked) == sorted(["Erste", ",", "!", "\n", "?", " 12", " \u03b1\u03b2", " \u6f22\u5b57", " x\u02b0"])
    letters = [chr(i) for i in range(1, 0x400)]
    for text in ["x a%sb. %sb\n%s %s! q%s, \n%s" % ((x,) * 6) for x in letters]:
        assert cache.encode(text) == np.array(tok.encode(text, add_special_tokens=False).ids, cache.kind).tobytes(), text


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=12), st.lists(st.integers(0, 3), max_size=20))
def test_myers(pattern, text):
    peq = {}
    for i, w in enumerate(pattern):
        peq[w] = peq.get(w, 0) | 1 << i
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[j - 1] + 1))
        row = new
    assert decontaminate.myers_end(peq, len(pattern), text)[0] == min(row)


def test_decontamination(spark):
    item = [f"Item{i}" for i in range(40)]
    edited = list(item)
    edited[5], edited[20] = "changed", "other"
    bench = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, ""), (4, "short one")], "item_id long, text string")
    rows = [(1, "before " + " ".join(item) + " after"), (2, "x " + ", ".join(edited).lower()), (3, " ".join(item[:20])), (4, None), (5, ""), (6, "a Short, one b"), (None, " ".join(item))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r)[:3] for r in decontaminate.find_items(df, bench).collect()), key=repr)
    assert got == sorted([(1, 1, 0), (2, 1, 2), (6, 4, 0), (None, 1, 0)], key=repr)
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(df, bench).collect()) == [3, 4, 5]


def brute_span(item, text, k):
    """(edits, end, -start) over all substrings: fewest edits, first end, shortest; None beyond k."""
    best = None
    for start in range(len(text) + 1):
        row = list(range(len(item) + 1))
        cells = [(row[-1], start, -start)]
        for j in range(start, len(text)):
            new = [row[0] + 1]
            for i, w in enumerate(item, 1):
                new.append(min(row[i - 1] + (w != text[j]), row[i] + 1, new[i - 1] + 1))
            row = new
            cells.append((row[-1], j + 1, -start))
        best = min([best, *cells] if best else cells)
    return best if best[0] <= k else None


def test_decontamination_equals_brute_force(spark):
    rng = np.random.default_rng(12)
    words = [f"w{i}" for i in range(30)]
    items = [list(rng.choice(words, n)) for n in (3, 10, 12, 20, 20, 25, 31)] + [["w1"] * 20]
    rows = []
    for d in range(120):
        t = list(rng.choice(words, int(rng.integers(0, 25))))
        for _ in range(int(rng.integers(0, 3))):
            it = list(items[rng.integers(len(items))])
            for _ in range(int(rng.integers(0, 4))):
                at = int(rng.integers(len(it)))
                it[at : at + 1] = [[], ["new"], [it[at], "more"]][rng.integers(3)]
            t += it + list(rng.choice(words, int(rng.integers(0, 8))))
        rows.append((d, " ".join(t), "x"))
    df = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(i, " ".join(it), 1) for i, it in enumerate(items)], "item_id long, text string, edits int")
    expect = set()
    for d, t, _ in rows:
        for i, it in enumerate(items):
            got = brute_span(it, t.split(), decontaminate.budget(len(it), 0.1, 5))
            if got:
                expect.add((d, i, got[0], -got[2], got[1]))
    assert {tuple(r) for r in decontaminate.find_items(df, bench).collect()} == expect
    hit = {d for d, *_ in expect}
    assert len(hit) > 40 and {r.doc_id for r in decontaminate.drop_contaminated(df, bench).collect()} == set(range(120)) - hit
    # no items, a very long text, repeated rows
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_items(df, none).count() == 0 and decontaminate.drop_contaminated(df, none).count() == 120
    long = "z " * 50_000 + " ".join(items[5])
    twice = spark.createDataFrame([(1, long), (1, long)], "doc_id long, text string")
    assert [tuple(r) for r in decontaminate.find_items(twice, bench).where("item_id = 5").collect()] == [(1, 5, 0, 50_000, 50_025)] * 2


def test_language(spark):
    en, de = "the quick thing and then some other words with which they think", "der schnelle und dann noch andere worte mit denen sie denken ich"
    rows = [(i, " ".join(np.random.default_rng(i).permutation((en if i % 2 else de).split())), "en" if i % 2 else "de") for i in range(200)]
    df = spark.createDataFrame(rows + [(900, None, "en"), (901, "12 34 !!", "de"), (902, en, None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.predict(df, language.fit(df)).collect()}
    assert all(got[i].lang_pred == ("en" if i % 2 else "de") for i in range(200))
    assert got[900].lang_pred == got[901].lang_pred == "und" and got[902].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in got.values()) and got[5].held_out == (zlib.crc32(b"5") % 5 == 0)


def test_language_equals_brute_force(spark):
    """400 languages, each learned; labels and scores from the nearest centroid by a plain loop."""
    rng = np.random.default_rng(9)
    letters = list("abcdefghijklmnopqrstuvwxyzäöüéèñçßøåπλθωждфц")
    rows = []
    for k in range(400):
        words = ["".join(rng.choice(letters, 5)) for _ in range(12)]
        rows += [(10 * k + i, " ".join(rng.choice(words, 20)), f"l{k:03d}") for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(df)
    assert len(model.langs) == 400
    got = language.predict(df, model).collect()
    assert sum(r.lang_pred == f"l{r.doc_id // 10:03d}" for r in got if r.held_out) >= 0.99 * sum(r.held_out for r in got)
    texts = {d: t for d, t, _ in rows}
    for r in got[::97]:
        tf = np.zeros(language.DIM)
        for w in texts[r.doc_id].split():
            ((_, x),) = language.counts(pa.array([f" {w} "]))
            tf += np.expm1(x[0])
        v = np.log1p(tf) * model.idf
        cos = model.c @ (v / np.linalg.norm(v))
        best = [max(c for c, o in zip(cos, model.of) if o == i) for i in range(400)]
        e = np.exp(20 * (np.array(best) - max(best)))
        assert r.lang_pred == model.langs[int(np.argmax(best))] and r.score == pytest.approx(1 / e.sum(), rel=1e-3)
    twice = spark.createDataFrame([(1, rows[0][1], "x", 1), (1, rows[0][1], "y", 2)], "doc_id long, text string, lang string, score int")
    assert len({tuple(r) for r in language.predict(twice, model).collect()}) == 1 and language.predict(twice, model).count() == 2


def test_dense_counts_are_bounded():
    assert max(len(x) for _, x in language.counts(pa.array(["short"] * 5000))) == language.ROWS


def test_quality(spark):
    good, bad = "Some plain words make a sentence here. And another one follows it.", "THIS!! IS!! ALL!! SHOUTED!! ### $$$"
    rows = [(i, f"{good if i % 4 else bad} {i}") for i in range(200)] + [(900, None), (901, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(200)] + [(5000, 1), (3, None)], "doc_id long, quality int")
    model = quality.fit(df, labels)
    got = {r.doc_id: r for r in quality.score(df, model).collect()}
    assert all(got[i].predicted == int(i % 4 > 0) for i in range(200)) and got[900].score == got[901].score
    assert quality.drop_rejected(df, model).where("doc_id < 200").count() == 150


def test_quality_equals_brute_force(spark):
    """Scores from the definition; worthless words in good layout rank below others; odd tables."""
    rng = np.random.default_rng(2)
    good, bad = [f"plain{i}" for i in range(60)], [f"filler{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(good if i % 3 else bad, 40)) + ".", i, "x") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality long, score string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 5.0) for i in range(400)] * 2, "doc_id long, quality int, text double")
    model = quality.fit(df, labels)
    got = quality.score(df, model).collect()
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == int(r.doc_id % 3 > 0) for r in held) >= 0.97 * len(held)
    texts = {r[0]: r[1] for r in rows}
    for r in got[::29]:
        column = pa.array([texts[r.doc_id]])
        x = np.concatenate([quality.features(column)[0], quality.word_shares(column)[0]])
        worth = float(((x - model.center) / model.scale) @ model.w)
        logit = np.log(0.3 / 0.7) + 2 * (worth - model.at) / model.spread
        assert r.score == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-5)
    twice = df.where("doc_id = 7").unionAll(df.where("doc_id = 7"))
    assert quality.score(twice, model).count() == 2 and quality.drop_rejected(twice, model).columns == df.columns
    one_class = quality.fit(df, labels.where("quality = 1"))
    assert {r.score for r in quality.score(df, one_class).collect()} == {0.3}


def brute_spans(t):
    found = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, "assign", m.end()))
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))


def test_secrets(spark, docs):
    texts = ["token = \"abc\" Secret:token: abcdefgh", "é API_KEY='abcdef12' AKIA" + "X9" * 10, "deadbeef" * 4 + " " + "A" * 30, "password=token=abcdefgh", " passwd : hunter22", "gh" + "p_" + "a1" * 20, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in secrets.scan(df).collect()}
    for i, t in enumerate(texts):
        assert got[i].base_sha256 == hashlib.sha256(brute_spans(t).encode()).hexdigest(), t
    assert "repository_token:0:44" in got[5].spans
    assert secrets.scan(docs).count() == docs.count()
    assert secrets.trigram_query(r"[0-9a-f]{24,}") == [] and secrets.trigram_query("AKIA[A-Z0-9]+") == [[frozenset({"aki", "kia"})]]


def test_trigram_index(spark, docs):
    """Postings against a plain search, Boolean queries against the texts, candidates against the rules."""
    wanted = secrets.index_trigrams()
    texts = ["my token is", "TOKEN", "ssword pa", "-----begin rsa private key-----", "eyJabc.eyJ", "", None, "API_key", "apikey", "ghp_ aiza"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(1, "TOKEN"), (None, "a Secret")], "doc_id long, text string")
    index = secrets.postings(df)
    expect = sorted((i or 0, t) for i, x in [*enumerate(texts), (1, "TOKEN"), (None, "a Secret")] for t in wanted if t in (x or "").lower())
    assert sorted((r.k, r.trigram) for r in index.collect()) == expect
    got = {r.k: [secrets.RULES[i].kind for i in r.rules] for r in secrets.candidates(index).collect()}
    assert got == {0: ["assign"], 1: ["assign"], 3: ["private_key"], 4: ["web_token"], 7: ["assign"], 8: ["assign"], 9: ["repository_token", "map_key"]}
    for rule in secrets.RULES:
        assert secrets.scan(docs, [rule, secrets.RULES[2]]).count() == docs.count()


@pytest.mark.parametrize("regex, runs", [("a[bc]?d", [{"abd", "acd", "ad"}]), ("(?i)(x|yz)+w", [{""}, {"w"}]), (r"q\x20r{2}", [{"q "}, {""}]), ("ab|cd", [{"ab", "cd"}]), ("a|b*", [])])
def test_literal_runs(regex, runs):
    assert secrets.literal_runs(regex) == runs


def test_url_filter(spark):
    urls = ["http://WWW.a.net/x", "https://m.example.net/en/1", "http://b.example.com/de/", "http://q.org/fr/?x", "http://casino-1.com/", "http://casinos.com/", "http://free-bets.com/a", "http://free.com", "nothing", None, "http://x.net?y/", "http://q.org/FR/"]
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = url_filter.judge_urls(df)
    assert [r.verdict for r in got.orderBy("page_id").collect()] == ["block", "allow", "block", "allow", "block", "allow", "block", "allow", "allow", "allow", "allow", "allow"]
    pages = got.toPandas()  # noqa: F841
    c = duckdb.connect()
    c.register("pages_df", df.toPandas())
    c.sql("create view pages as select * from pages_df")
    key = lambda f: sorted(map(repr, f[sorted(f.columns)].astype(object).where(f.notna(), None).itertuples(index=False)))
    assert key(c.sql(url_filter.oracle()).df()) == key(pages)


def test_mixing(spark):
    rows = [(i, f"s{i % 3 if i % 5 else 0}" if i % 17 else None, "w " * (1 + i * 7 % 40)) for i in range(600)]
    df = spark.createDataFrame(rows + [(600, "s0", None), (601, "tiny", "one two")], "doc_id long, source string, text string")
    got = mixing.mix(df).collect()
    sizes, limit = collections.Counter(), {}
    for r in got:
        sizes[r.source] += r.size
        limit[r.source] = r.target
        assert r.taken <= 3 * r.size
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, capped = {}, set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in capped)
        open_ = [s for s in names if s not in capped]
        target = {s: 3 * sizes[s] if s in capped else left * weight[s] / sum(weight[o] for o in open_) for s in names}
        over = {s for s in open_ if target[s] > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    taken = collections.Counter()
    for r in got:
        taken[r.source] += r.taken
    for s in names:
        assert limit[s] == pytest.approx(target[s])
        assert abs(taken[s] - target[s]) <= 5 * 16
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in mixing.mix(df.repartition(7)).collect())
    assert set(mixing.apply_mix(df).columns) == set(df.columns)


def test_mixing_equals_sql(spark, docs, empty):
    """Every document's taken words, on awkward rows and with columns that clash."""
    rows = [(i, f"s{i % 7}" if i % 11 else None, "w " * (i * 13 % 90), 5, i % 2, "b") for i in range(300)] + [(7, "s1", "two words", 5, 1, "b")] * 2 + [(None, "s1", None, 5, 1, "b"), (900, "rare", "x\x0by\fz", 5, 1, "b")]
    odd = spark.createDataFrame(rows, "doc_id long, source string, text string, row long, size int, block string")
    for df in (odd, docs, empty):
        c = duckdb.connect()
        c.register("rows_", df.select("doc_id", "source", "text").toArrow())
        c.sql("create view documents as select * from rows_")
        columns = ["doc_id", "size", "source_size", "target", "taken"]
        expect = c.sql(f"select {', '.join(columns)} from ({mixing.oracle()})").fetchall()
        assert sorted(map(repr, map(tuple, mixing.mix(df).select(columns).collect()))) == sorted(map(repr, expect))
    # schedule points are the golden ratio's multiples, without overflow
    got = spark.range(1).selectExpr(*[mixing.POINT.replace("t ", f"{t}L ") + f" AS c{i}" for i, t in enumerate((0, 1, 12345, 10**9, 2**41 + 5))]).first()
    assert list(got) == [t * mixing.PHI % mixing.SPAN for t in (0, 1, 12345, 10**9, 2**41 + 5)]


def test_sliding_minima():
    v = W.mix64(np.arange(1, 200, dtype=np.uint64) % np.uint64(37))
    got = substring_dedup.sliding_minima(v, 9)
    for i, p in enumerate(got):
        assert v[p] >> np.uint64(9) == min(v[i : i + 9]) >> np.uint64(9) and i <= p < i + 9


def test_windows_without_runs_need_no_tree(monkeypatch):
    """Bounds of windows come from the sliding minima; only a text with a node in a run of one token is walked."""
    rng = np.random.default_rng(2)
    texts = [" ".join(f"v{i}" for i in rng.integers(0, 40, n)) for n in (0, 5, 14, 300, 90)] + ["same " * 60 + "end"]
    walked, tree = [], substring_dedup.cartesian_windows
    monkeypatch.setattr(substring_dedup, "cartesian_windows", lambda at, value, lo, hi: walked.append(lo) or tree(at, value, lo, hi))
    (c,) = W.chunks(pa.array(texts))
    x, length = W.windows(c.hashes, 5), 10
    for f, (of, begin, l, at, r, _, _) in enumerate(substring_dedup.compact_windows(c, 5, length, 3)):
        v = substring_dedup._hashed(x, f)
        for i in range(5):
            lo, hi, expect = int(c.ptr[i]), int(c.ptr[i + 1]) - 4, {}
            for s in range(lo, hi - length + 1):
                expect.setdefault(s + int(np.argmin(v[s : s + length])), []).append(s)
            mine = np.flatnonzero(of == i)
            got = [(at[j], max(l[j], at[j] - length + 1), min(r[j], at[j] + length - 1)) for j in mine]
            assert got == [(p, q[0], q[-1] + length - 1) for p, q in sorted(expect.items())]
    assert set(walked) == {int(c.ptr[5])}


def test_passages(spark, docs):
    rng = np.random.default_rng(1)
    fresh = lambda d, n: [f"d{d}_{i}" for i in range(n)]
    shared, line = fresh("p", 60), fresh("line", 20)
    near = list(shared)
    near[30] = "changed"
    rows = []
    for d in range(40):
        t = fresh(d, int(rng.integers(60, 200)))
        if d < 10:
            t[30:30] = shared
        elif d == 10:
            t[5:5] = near
        t[10:10] = line
        rows.append((d, " ".join(t)))
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in got} == set(range(11))
    assert all(r.class_id == 0 and r.end_word - r.first_word >= 50 for r in got)
    assert all(r.first_word <= 50 and r.end_word >= 105 for r in got if r.doc_id < 10)
    assert {0, 1, 3}.issubset({r.doc_id for r in substring_dedup.repeated_passages(docs).collect()})


def test_passages_of_later_documents_only(spark):
    """Two late documents share 50 words, of which earlier documents have 40 each."""
    rows = []
    for g in range(24):
        fresh = lambda d, n: [f"g{g}d{d}_{i}" for i in range(n)]  # noqa: E731, B023
        w = fresh("p", 50)
        edited = [w[0], w[1], f"edited{g}", *w[3:]] if g % 2 else w
        rows += [(4 * g + d, " ".join(fresh(d, 60) + t + fresh(d + 4, 60))) for d, t in enumerate((w[:40], w[10:], w, edited))]
    got = {r.doc_id for r in substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {4 * g + d for g in range(24) for d in (2, 3)}


@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3), st.integers(0, 2)), max_size=40), st.integers(1, 7))
@settings(max_examples=200, deadline=None)
def test_shared_members_in_a_stream(rows, size):
    rows.sort(key=lambda r: r[0])
    batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[a : a + size])], ["key", "doc", "place"]) for a in range(0, len(rows), size)]
    got = [r for b in buckets._shared_batches(iter(batches), ["key", "doc", "place"]) for r in b.to_pylist()]
    by = collections.defaultdict(list)
    for key, *rest in rows:
        by[key].append(tuple(rest))
    expected = [(k, *r, min(v)) for k, v in by.items() if len({d for d, _ in v}) > 1 for r in v]
    assert sorted((r["key"], r["doc"], r["place"], (r["head"]["doc"], r["head"]["place"])) for r in got) == sorted(expected)


def test_fit_holds_one_copy_of_its_rows():
    rng = np.random.default_rng(3)
    x, y = rng.random((4000, len(quality.NAMES) + quality.BUCKETS), np.float32), rng.integers(0, 2, 4000)
    tracemalloc.start()
    quality.Ranker(x, y, 0.3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.6 * 8 * x.size


def test_pairs_of_a_common_line(spark, monkeypatch):
    """80 texts share a line of 30 words, and 14 words on either side with one other text each: no passage, and few pairs."""
    fresh = lambda d, n: [f"{d}_{i}" for i in range(n)]
    line, m = fresh("line", 30), 40
    texts = [fresh(f"l{k % m}", 14) + line + fresh(f"r{(k + k // m) % m}", 14) for k in range(2 * m)]
    pairs, written = [], substring_dedup.materialize

    def counted(df, name):
        out = written(df, name)
        if name == "anchors":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(substring_dedup, "materialize", counted)
    got = substring_dedup.repeated_passages(spark.createDataFrame([(d, " ".join(t)) for d, t in enumerate(texts)], "doc_id long, text string"))
    assert got.isEmpty()
    assert len(pairs) > 1 and sum(pairs) <= 4 * len(texts)


def test_possible_windows_keep_a_shared_shingle():
    """Every two similar windows around a minimum of theirs have one of their rarest shingles in common."""
    rng, length = np.random.default_rng(5), 16
    base = [f"w{i}" for i in range(60)]
    texts = []
    for d in range(40):
        t = list(base if d % 2 else [base[int(i)] for i in rng.integers(0, 60, 60)])
        for at in rng.integers(0, 60, 3):
            t[at] = f"w{rng.integers(0, 60)}"
        texts.append(" ".join(t))
    x, offsets = substring_dedup._tokens(pa.array(texts), 1)
    own = [x[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
    tokens, n = np.unique(np.concatenate([np.unique(o) for o in own]), return_counts=True)
    common = [[{"x": int(t), "n": int(c)} for t, c in zip(tokens.view(np.int64), n) if c > 1 and t in o.view(np.int64)] for o in own]
    open_ = [[{"place": c << 2 * substring_dedup.REACH_BITS} for c in range(len(o))] for o in own]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts)), pa.int64()), pa.array(texts), pa.array(open_, pa.list_(pa.struct({"place": pa.int64()}))), pa.array(common, pa.list_(pa.struct({"x": pa.int64(), "n": pa.int64()})))],
        ["doc", "text", "open", "common"],
    )
    found = {}
    for b in substring_dedup._possible_batches([batch], 1, length, 80, 100):
        for r in b.to_pylist():
            found[r["doc"], r["place"] >> 2 * substring_dedup.REACH_BITS] = (set(r["rare"]), set(r["rare"][: r["sure"]]), r["odd"])
    met = [0, 0]
    for a in range(len(own)):
        for b in range(a):
            for s in range(0, 60 - length + 1, 3):
                for t in range(max(s - 3, 0), min(s + 4, 60 - length + 1)):
                    v, w = own[a][s : s + length], own[b][t : t + length]
                    if substring_dedup._similar(v, w, 80, 100):
                        shared = sorted(set(v.tolist()) & set(w.tolist()))[0]
                        c, h = s + v.tolist().index(shared), t + w.tolist().index(shared)
                        (wide, sure, odd), (wide2, sure2, odd2) = found[a, c], found[b, h]
                        uneven = odd or odd2
                        assert (wide & wide2) if uneven else (sure & sure2)
                        met[uneven] += 1
    assert min(met) > 0


def test_classes_of_passages(spark):
    """A chain 0 - 1 - 2 over overlapping shares of one passage is one class; copies count each other."""
    fresh = lambda d, n: [f"d{d}_{i}" for i in range(n)]
    p, q = fresh("p", 160), fresh("q", 70)
    parts = [p[:100], p, p[60:], *[q] * 5]
    rows = [(d, " ".join(fresh(d, 60) + t + fresh(d + 100, 60))) for d, t in enumerate(parts)]
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add((r.class_id, r.n_links))
    assert by[3] == {(3, 4)} and all(by[d] == by[3] for d in range(3, 8))
    assert by[0] == by[1] == by[2] == {(0, 2)}


def test_oracle_keys():
    assert set(queries.oracle_sql()) <= set(queries.queries())

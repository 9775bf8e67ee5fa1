"""Secret scan with a trigram inverted index, in SQL functions only.

Each rule's regular expression is turned into a Boolean query of trigrams that every match must
hold, in lower case: all of its literal runs, and of each run one of its spellings. The index has
one row per distinct (trigram, text) for the trigrams that some rule asks for. Postings are
brought together by text, and a text whose trigrams satisfy a rule's query is that rule's
candidate. Candidates are joined back to their texts and verified with the expression; rules
without a mandatory trigram scan every text. Only candidates' texts are joined, all others give
their short rows of spans.

Matches are marked by a character that is first replaced in the text, so positions count code
points. Null texts are empty and have no spans. Repeated rows are each scanned; spans depend on
the text alone, so rows with equal id and text share what was found. Extra columns are ignored.
An empty table gives an empty result.
"""

from dataclasses import dataclass

from pyspark.sql import functions as F

from quillon.session import materialize

#: Candidates are broadcast up to so many rows (about 100 bytes each), else joined by a shuffle.
BROADCAST_ROWS = 500_000
MARK, OTHER = "\ue000", "\ufffd"


@dataclass(frozen=True)
class Rule:
    """kind, its expression, the group that must have `least` characters (0: the match)."""

    kind: str
    regex: str
    group: int = 0
    least: int = 1
    base: bool = False


RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24, True),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("repository_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
    Rule("map_key", r"AIza[A-Za-z0-9_-]{35}"),
)


class _Parser:
    """Sequences of (what, least, most) from an expression; what is a set of characters, None for a large one, or alternatives."""

    def __init__(self, regex):
        self.regex, self.at = regex.removeprefix("(?i)"), 0

    def peek(self):
        return self.regex[self.at : self.at + 1]

    def take(self):
        self.at += 1
        return self.regex[self.at - 1]

    def alternatives(self):
        found = [self.sequence()]
        while self.peek() == "|":
            self.take()
            found.append(self.sequence())
        return found

    def sequence(self):
        items = []
        while self.peek() not in ("", "|", ")"):
            what = self.atom()
            items.append((what, *self.times()))
        return items

    def atom(self):
        c = self.take()
        if c == "(":
            if self.regex.startswith("?:", self.at):
                self.at += 2
            found = self.alternatives()
            self.take()
            return found
        if c == "[":
            return self.char_class()
        return None if c == "." else {self.escaped() if c == "\\" else c}

    def escaped(self):
        c = self.take()
        if c == "x":
            self.at += 2
            return chr(int(self.regex[self.at - 2 : self.at], 16))
        if c.isalnum():
            raise ValueError(f"\\{c} is not supported")
        return c

    def char_class(self, most=8):
        if self.peek() == "^":
            raise ValueError("negated classes are not supported")
        chars, n = set(), 0
        while (c := self.take()) != "]":
            low = self.escaped() if c == "\\" else c
            high = low
            if self.peek() == "-" and self.regex[self.at + 1] != "]":
                self.take()
                high = self.take()
            n += ord(high) - ord(low) + 1
            if n <= most:
                chars |= {chr(i) for i in range(ord(low), ord(high) + 1)}
        return chars if n <= most else None

    def times(self):
        c = self.peek()
        if c in ("?", "*", "+"):
            self.take()
            return {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
        if c == "{":
            inside, self.at = self.regex[self.at + 1 : self.regex.index("}", self.at)], self.regex.index("}", self.at) + 1
            low, comma, high = inside.partition(",")
            return int(low), int(high) if high else None if comma else int(low)
        return 1, 1


def _spellings(items, most=64):
    """All strings of a sequence in lower case, or None when they aren't a small set."""
    out = {""}
    for what, least, times in items:
        if times != 1 or what is None:
            return None
        if isinstance(what, set):
            some = {c.lower() for c in what}
        else:
            parts = [_spellings(x) for x in what]
            if None in parts:
                return None
            some = set().union(*parts)
        some = some | ({""} if least == 0 else set())
        if len(out) * len(some) > most:
            return None
        out = {a + b for a in out for b in some}
    return out


def literal_runs(regex, most=64):
    """Sets of strings, in order; each match holds one string of every set."""
    found = _Parser(regex).alternatives()
    if len(found) > 1:
        whole = [_spellings(x) for x in found]
        return [] if None in whole else [set().union(*whole)]
    runs, run = [], {""}
    for item in found[0]:
        some = _spellings([item])
        if some is None or len(run) * len(some) > most:
            runs.append(run)
            run = {""}
        if some is not None:
            run = {a + b for a in run for b in some}
    return [*runs, run]


def trigram_query(regex):
    """List of alternatives lists: every inner list has sets of trigrams, one of which must be held whole."""
    query = []
    for run in literal_runs(regex):
        if all(len(s) >= 3 for s in run):
            query.append([frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in sorted(run)])
    return query


def index_trigrams(rules=RULES):
    return sorted({t for r in rules for any_of in trigram_query(r.regex) for all_of in any_of for t in all_of})


def _keyed(docs):
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return rows.select("doc_id", F.coalesce("doc_id", F.lit(0)).alias("k"), F.xxhash64("text").alias("h"), "text")


def postings(docs, rules=RULES):
    """The index: trigram and the text (k, h) that has it, once each for equal rows of a partition."""
    # exploded, so that each text is lowered once and not for each trigram again
    low = _keyed(docs).select("k", "h", F.explode(F.array(F.lower("text"))).alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in index_trigrams(rules)]))
    return low.select("k", "h", F.explode(held).alias("trigram"))


def candidates(index, rules=RULES):
    """The texts (k, h) that satisfy some rule's query, and which rules' (by number)."""
    held = index.groupBy("k", "h").agg(F.collect_set("trigram").alias("held"))
    fits = []
    for i, rule in enumerate(rules):
        query = trigram_query(rule.regex)
        if query:
            has = lambda t: F.array_contains("held", t)
            every = lambda cs, f: f(cs[0], every(cs[1:], f)) if len(cs) > 1 else cs[0]
            both, either = (lambda a, b: a & b), (lambda a, b: a | b)
            ok = every([every([every([has(t) for t in sorted(all_of)], both) for all_of in any_of], either) for any_of in query], both)
            fits.append(F.when(ok, F.lit(i)))
    if not fits:
        return held.select("k", "h", F.array().cast("array<int>").alias("rules")).limit(0)
    return held.select("k", "h", F.array_compact(F.array(*fits)).alias("rules")).where(F.size("rules") > 0)


SPAN = "array<struct<start: int, nth: int, kind: string, end: int>>"


def _spans(i, rule):
    """Spans from the parts column p{i}: text between, match, group, again and again."""
    p = f"p{i}"
    step = (
        f"named_struct('at', a.at + length({p}[3 * j]) + length({p}[3 * j + 1]), 'out', "
        f"if(length({p}[3 * j + 2]) >= {rule.least}, concat(a.out, array(named_struct('start', a.at + length({p}[3 * j]), 'nth', {i}, 'kind', '{rule.kind}', "
        f"'end', a.at + length({p}[3 * j]) + length({p}[3 * j + 1])))), a.out))"
    )
    none = f"cast(array() as {SPAN})"
    return F.expr(f"if({p} is null or size({p}) < 4, {none}, aggregate(sequence(0, (size({p}) - 1) div 3 - 1), named_struct('at', 0, 'out', {none}), (a, j) -> {step}, a -> a.out))")


def _marked(rule):
    """The text split at the rule's matches: text between, match, group, again and again."""
    clean = F.translate("text", MARK, OTHER)
    marked = F.regexp_replace(clean, F.lit(rule.regex), F.lit(f"{MARK}$0{MARK}${rule.group}{MARK}"))
    return F.when(F.col("text").rlike(rule.regex), F.split(marked, MARK, -1))


def scan(docs, rules=RULES):
    """One row per document: doc_id, n_<kind> of the base rules, base_sha256, spans."""
    indexed = [i for i, r in enumerate(rules) if trigram_query(r.regex)]
    rest = [i for i in range(len(rules)) if i not in indexed]
    chosen = materialize(candidates(postings(docs, rules), rules), "candidates")
    found = _keyed(docs).join(F.broadcast(chosen) if chosen.count() <= BROADCAST_ROWS else chosen, ["k", "h"])
    found = found.select("k", "h", *[F.when(F.array_contains("rules", i), _marked(rules[i])).alias(f"p{i}") for i in indexed])
    found = found.select("k", "h", *[_spans(i, rules[i]).alias(f"s{i}") for i in indexed]).dropDuplicates(["k", "h"])
    rows = _keyed(docs).select("doc_id", "k", "h", *[_marked(rules[i]).alias(f"p{i}") for i in rest])
    rows = rows.select("doc_id", "k", "h", *[_spans(i, rules[i]).alias(f"s{i}") for i in rest])
    rows = rows.join(found, ["k", "h"], "left")
    rows = rows.select("doc_id", *[f"s{i}" for i in rest], *[F.coalesce(f"s{i}", F.expr(f"cast(array() as {SPAN})")).alias(f"s{i}") for i in indexed])
    joined = lambda some: F.array_join(F.transform(F.array_sort(F.concat(*[F.col(f"s{i}") for i in some])), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = [i for i, r in enumerate(rules) if r.base]
    return rows.select("doc_id", *[F.size(f"s{i}").cast("long").alias(f"n_{rules[i].kind}") for i in base], F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(range(len(rules))).alias("spans"))


def oracle(rules=RULES):
    """DuckDB SQL for scan over documents: every rule on every text, without the index."""
    cols, lists = [], []
    for i, r in enumerate(rules):
        regex = r.regex.replace("'", "''").replace(r"\x20", " ")
        cols.append(f"string_split(regexp_replace(t, '{regex}', '{MARK}\\0{MARK}\\{r.group}{MARK}', 'g'), '{MARK}') AS p{i}")
        ends = f"list_sum([length(p{i}[k]) FOR k IN range(1, 3 * j + 3) IF k % 3 <> 0])"
        lists.append(
            f"[struct_pack(s := CAST({ends} - length(p{i}[3 * j + 2]) AS BIGINT), n := {i}, k := '{r.kind}', e := CAST({ends} AS BIGINT)) "
            f"FOR j IN range(0, (len(p{i}) - 1) // 3) IF length(p{i}[3 * j + 3]) >= {r.least}] AS s{i}"
        )
    joined = lambda some: f"coalesce(list_aggregate([k.k || ':' || k.s || ':' || k.e FOR k IN list_sort(list_concat({', '.join(f's{i}' for i in some)}))], 'string_agg', ','), '')"
    base = [i for i, r in enumerate(rules) if r.base]
    counts = ", ".join(f"CAST(len(s{i}) AS BIGINT) AS n_{rules[i].kind}" for i in base)
    return f"""
WITH a AS (SELECT doc_id, replace(coalesce(text, ''), '{MARK}', '{OTHER}') AS t FROM documents),
b AS (SELECT doc_id, {', '.join(cols)} FROM a),
c AS (SELECT doc_id, {', '.join(lists)} FROM b),
d AS (SELECT doc_id, {counts}, {joined(base)} AS base, {joined(range(len(rules)))} AS spans FROM c)
SELECT doc_id, {', '.join(f'n_{rules[i].kind}' for i in base)}, sha256(base) AS base_sha256, spans FROM d"""

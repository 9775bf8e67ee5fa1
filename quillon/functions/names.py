"""Sample names: scheme, protein, enrichment, and the order in which they are listed."""

from pyspark.sql import functions as F

from quillon.functions.seq import col

#: Spellings of the two signs that occur in names.
SIGNS = {"POSITIVE": ("POISITIVE", "POITIVE", "POSITVE", "POSITIVE"), "NEGATIVE": ("NEGAITIVE", "NEGTAIVE", "NEGATIVE")}
TOKEN = "(?:" + "|".join(s for every in SIGNS.values() for s in every) + ")"
KH = r"KH\s*[-_ ]?"
MAGE = r"MAGE[-_ ]?A?3"
#: Places of enrichments within a protein: those of two proteins, of one dataset, and of all others.
ORDER_SPECIAL = {"2xnegative": 1, "2xpositive": 2, "3xpositive": 3, "31xpositive": 4}
ORDER_DMF5 = {"2xnegative": 1, "1xpositive": 2, "2xpositive": 3}
ORDER = {"1xpositive": 1, "2xpositive": 2, "2xnegative": 3, "3xpositive": 4, "31xpositive": 5}


def scheme(name):
    """legacy, kh_style or unknown."""
    s = F.upper(col(name))
    kh = s.rlike(KH + r"\d{3}") | s.rlike(rf"\b{MAGE}\b") | s.contains("TITIN") | s.contains("TININ")
    return F.when(s.rlike(r"GIG\s*0*\d+|DRG\s*0*\d+"), "legacy").when(kh, "kh_style").otherwise("unknown")


def _enrichment(text):
    s = F.regexp_replace(F.upper(text), r"[\s_,-]+", "")
    for right, spellings in SIGNS.items():
        s = F.regexp_replace(s, "|".join(spellings), right)
    times = F.regexp_extract(s, r"(\d+)X(POSITIVE|NEGATIVE)", 1)
    sign = F.lower(F.regexp_extract(s, r"(\d+)X(POSITIVE|NEGATIVE)", 2))
    return F.when(times == "", "unknown").otherwise(F.concat(times.try_cast("long").cast("string"), F.lit("x"), sign))


def _numbered(prefix, number, width):
    n = number.try_cast("long").cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(n) >= width, n).otherwise(F.lpad(n, width, "0")))


def protein_and_enrichment(name):
    """struct(protein, enrichment) of a sample name.

    A protein followed at once by an enrichment is read first, then each is looked for anywhere;
    names of the KH style keep the enrichments of their design only.
    """
    s = F.upper(col(name))
    times = rf"(\d+\s*X\s*{TOKEN})"
    found = F
    pair = lambda p, e: F.struct(p.alias("protein"), e.alias("enrichment"))
    library = s.contains("ORILIB") | s.contains("ORIGINALLIB") | s.contains("ORIGINAL")
    found = found.when(library, pair(F.lit("ORILIB"), F.lit("original lib")))
    for prefix, regex, width in (("GIG", rf"GIG0*(\d+)(?={times})", 2), ("DRG", rf"DRG0*(\d+)(?={times})", 2), ("KH", rf"{KH}(\d{{3}})(?={times})", 3)):
        found = found.when(s.rlike(regex), pair(_numbered(prefix, F.regexp_extract(s, regex, 1), width), _enrichment(F.regexp_extract(s, regex, 2))))
    for protein, regex in (("MAGE-A3", rf"{MAGE}(?={times})"), ("TITIN", rf"(?:TITIN|TININ)(?={times})")):
        found = found.when(s.rlike(regex), pair(F.lit(protein), _enrichment(F.regexp_extract(s, regex, 1))))
    protein = F
    for prefix, regex, width in (("GIG", r"GIG\s*0*(\d+)(?!\d)", 2), ("DRG", r"DRG\s*0*(\d+)(?!\d)", 2), ("KH", rf"{KH}(\d{{3}})(?!\d)", 3)):
        protein = protein.when(s.rlike(regex), _numbered(prefix, F.regexp_extract(s, regex, 1), width))
    protein = protein.when(s.rlike(rf"\b{MAGE}\b"), "MAGE-A3").when(s.contains("TITIN") | s.contains("TININ"), "TITIN").otherwise("UNKNOWN")
    enrichment = _enrichment(F.regexp_extract(s, rf"\d+\s*X\s*{TOKEN}", 0))
    allowed = enrichment.isin("2xnegative", "3xpositive", "31xpositive") | ((enrichment == "2xpositive") & protein.isin("TITIN", "MAGE-A3"))
    return found.otherwise(pair(protein, F.when((scheme(name) == "kh_style") & ~allowed, "unknown").otherwise(enrichment)))


def enrichment_rank(enrichment, protein=None, dmf5=False):
    """The place of an enrichment in listings."""
    e = col(enrichment)

    def of(table, out, when=None):
        for name, rank in table.items():
            hit = e == name
            out = out.when(hit if when is None else hit & when, rank)
        return out

    out = F.when(e == "original lib", 0)
    if protein is not None:
        out = of(ORDER_SPECIAL, out, F.upper(col(protein)).isin("TITIN", "MAGE-A3"))
    if dmf5:
        out = of(ORDER_DMF5, out)
    out = of(ORDER, out)
    number = F.regexp_extract(F.lower(e), r"^(\d+)x(positive|negative)", 1)
    other = 10 + 2 * number.try_cast("int") + F.when(F.lower(e).rlike(r"^\d+xnegative"), 1).otherwise(0)
    return F.coalesce(out.otherwise(other), F.lit(999))


def protein_order(protein):
    """struct(class, name, number, protein): sorts proteins by kind and number, not letter by letter."""
    p = F.upper(col(protein))
    key = lambda k, name, n: F.struct(F.lit(k).alias("class"), name.alias("name"), n.try_cast("int").alias("number"), p.alias("protein"))
    out = F
    for k, (name, regex) in enumerate((("GIG", r"^GIG0*(\d+)$"), ("DRG", r"^DRG0*(\d+)$"), ("KH", r"^KH(\d{3})$"))):
        out = out.when(p.rlike(regex), key(k, F.lit(name), F.regexp_extract(p, regex, 1)))
    out = out.when(p == "MAGE-A3", key(3, p, F.lit("0"))).when(p == "TITIN", key(4, p, F.lit("0")))
    other = r"^([A-Z]+)0*(\d+)$"
    out = out.when(p.rlike(other), key(5, F.regexp_extract(p, other, 1), F.regexp_extract(p, other, 2)))
    return out.when(p == "ORILIB", key(98, p, F.lit("0"))).otherwise(key(99, p, F.lit("999999")))

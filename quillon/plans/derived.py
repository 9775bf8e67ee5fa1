"""Reads and selection rows derived from the driver's tables, as SQL text that Spark and DuckDB share."""

from quillon.session import materialize

HEX = "'0123456789abcdef'"
ANCHOR = "ACATGACG"
_K = "cast(l_orderkey AS string)"
_E = f"md5(concat('e', {_K}, '-', cast(l_linenumber AS string)))"
_DNA = f"{HEX}, 'ACGTACGTACGTACGT'"

#: lineitem rows as sequencing reads: one barcode an order, one template, errors and qualities by hash.
READS = f"""
SELECT k, read_no, umi0, tmpl, concat(spacer, umi0, anchor, ins) AS seq, concat(repeat('I', CAST(length(spacer) + 20 AS int)), q33) AS qual
FROM (SELECT k, read_no, umi0, tmpl, spacer, anchor, q33,
        CASE WHEN substr(e, 3, 1) < '5' THEN concat(substr(tmpl, 1, CAST(ascii(substr(e, 1, 1)) % 33 AS int)), translate(substr(e, 2, 1), {_DNA}), substr(tmpl, CAST(ascii(substr(e, 1, 1)) % 33 + 2 AS int))) ELSE tmpl END AS ins
      FROM (SELECT l_orderkey AS k, l_linenumber AS read_no, {_E} AS e,
              translate(substr(md5(concat('u', {_K})), 1, 12), {_DNA}) AS umi0,
              translate(concat(md5(concat('t', cast(l_orderkey % 997 AS string))), 'a'), {_DNA}) AS tmpl,
              substr('ACG', 1, CAST(ascii(substr({_E}, 4, 1)) % 4 AS int)) AS spacer,
              CASE substr({_E}, 5, 1) WHEN '0' THEN 'ACATGTCG' WHEN '1' THEN 'TTTTTTTT' ELSE '{ANCHOR}' END AS anchor,
              translate(concat(md5(concat('q', {_E})), 'a'), {HEX}, '&+0359:;=@BDFGHI') AS q33
            FROM lineitem) x) y
"""

SELECTION = f"""
SELECT p_brand AS peptide, translate(substr(md5(p_name), 1, 11), {HEX}, 'ACDEFGHIKLMNPQRS') AS aa_seq,
    CASE concat(l_returnflag, l_linestatus) WHEN 'AO' THEN 'lib' WHEN 'AF' THEN 'neg' WHEN 'RO' THEN 'pos3x' WHEN 'NO' THEN 'pos1x' END AS condition
FROM lineitem JOIN part ON l_partkey = p_partkey
"""

#: Template regions of orders, with some without an anchor, short or with N.
REGIONS = f"""
SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 = 0 THEN substr(s, 1, 40) WHEN o_orderkey % 13 = 0 THEN replace(s, 'GAA', 'NAA') ELSE s END AS seq
FROM (SELECT o_orderkey, concat(translate(substr(md5(concat('p', cast(o_orderkey AS string))), 1, 20), {_DNA}),
        CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE '{ANCHOR}' END, translate(concat(md5(concat('r', cast(o_orderkey % 499 AS string))), 'a'), {_DNA}), 'GAAC') AS s FROM orders) x
"""


def view(spark, sf_dir, sql, *tables):
    """The rows of shared SQL over tables of sf_dir; views carry names of their own."""
    for t in tables:
        name = f"quillon_{t}"
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(name)
        sql = sql.replace(f"FROM {t}", f"FROM {name}").replace(f"JOIN {t}", f"JOIN {name}")
    return spark.sql(sql)


_reads = {}


def reads(spark, sf_dir):
    """The reads of a folder, written once a session: their text is made of hashes that no query should work out again."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _reads:
        made = view(spark, sf_dir, READS, "lineitem")
        _reads[key] = materialize(made.repartition(spark.sparkContext.defaultParallelism), "reads").written_to, made.schema
    path, schema = _reads[key]
    return spark.read.schema(schema).parquet(path)


def selection(spark, sf_dir):
    return view(spark, sf_dir, SELECTION, "lineitem", "part")


def regions(spark, sf_dir):
    return view(spark, sf_dir, REGIONS, "orders")

"""Queries against the SQL that DuckDB runs on the same tables, and micro-fixtures on paper."""

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quillon.functions import search, seq as S
from quillon.operators import label, library, trim, umi
from quillon.plans import catalog

SF = "/root/testdata/sf0.001"


def rows(df):
    df = df[sorted(df.columns)].astype(object)
    return sorted(map(repr, ([None if pd.isna(x) else int(x) if isinstance(x, float) and x.is_integer() else x for x in r] for r in df.itertuples(index=False))))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in ("part", "lineitem", "orders", "events"):
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    assert rows(catalog.queries()[name](spark, SF).toPandas()) == rows(duck.sql(catalog.oracle_sql()[name]).df())


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_sequence_functions(spark):
    got = one(spark, S.reverse_complement(F.lit("ACGTN")), S.translate_region(F.lit("ATGTAANNNC")), S.last_find(F.lit("xxABxxABx"), "AB"), S.hamming(F.lit("ACGT"), F.lit("ACCTT")), S.quality_string(S.phred(F.lit("I!"))))
    assert tuple(got) == ("NACGT", "M*X", 7, 1, "I!")
    assert search.edit_matches("TTACGTAA", "ACGT", 1)[0][:2] == (2, 6)
    assert tuple(one(spark, search.last_substitution_hit(F.lit("ACGTxxACCT"), "ACGT", 1))) == (7,)


@pytest.mark.parametrize("reads, call, delta", [((("A", "?"), ("A", "?")), "A", 16.01), ((("A", "?"), ("C", "?")), "N", 0), ((("A", "'"),), "A", 2.191), ((("A", "&"),), "N", 1.87), ((("A", "!"),), "N", 0), ((("N", "?"),), "N", 0)])
def test_posterior_call(spark, reads, call, delta):
    df = spark.createDataFrame([("u", b, q) for b, q in reads], "umi string, insert string, insert_qual string")
    r = umi.posterior_columns(df).first()
    assert (r["call"], round(r["log_delta"], 2)) == (call, round(delta, 2))


def test_soft_and_classes(spark):
    df = spark.createDataFrame([("u", "a", 1)] * 6 + [("u", "b", 1)] * 3 + [("u", "c", 1), ("v", "a", 1)], "umi string, insert string, read_no int")
    assert sorted(r.insert for r in umi.soft(df).where("umi = 'u'").collect()) == ["a", "b"]
    assert {r.umi: r.kind for r in umi.classes(df, 3).collect()} == {"u": "consensus", "v": "singleton"}


def test_labels(spark):
    df = spark.createDataFrame([("p", "X", "lib")] + [("p", "Y", "lib")] * 3 + [("p", "Z", "neg")] * 4 + [("p", "X", "pos3x"), ("p", "X", "pos3x"), ("p", "Y", "pos3x"), ("p", "Y", "pos3x"), ("p", "Z", "pos1x")], "peptide string, aa_seq string, condition string")
    got = {r.aa_seq: r for r in label.label(label.wide_counts(df)).collect()}
    assert got["X"].specificity == 1 and got["X"].pos3x_vs_lib_status == "NoChange" and got["X"].neg_vs_lib_status == "Depleted"


def test_condition_names(spark):
    p, c = label.parse_condition(F.col("s"))
    df = spark.createDataFrame([(x,) for x in ("clibKH1603xpositive", "clibKH16031xpositive", "cliboriginallib", "foo")], "s string")
    assert [tuple(r) for r in df.select(p, c).collect()] == [("KH160", "pos3x"), ("KH160", "pos1x"), ("lib", "lib"), (None, None)]


def test_validation(spark):
    wt = "GCCAGC"
    df = spark.createDataFrame([(wt,), ("GCGAGC",), ("GCAAGC",), ("TAGAGC",)], "region string")
    assert [(r.reason, r.mutated) for r in library.validate_nnk(df, wt, 1).collect()] == [(None, []), (None, [1]), ("mutation_not_NNK", [1]), ("stop_codon", [1])]
    r = library.validate_combinatorial(spark.createDataFrame([("GCCTAA",)], "region string"), ("NNN", "SCN")).first()
    assert (r.reason, r.fail_pos) == ("stop_codon", 2)


def test_trim_modes(spark):
    df = spark.createDataFrame([("ACGTA", "II5II"), ("ACGTA", "III!!"), ("ACGTA", "!!!!!")], "seq string, qual string")
    assert [r.kept_length for r in trim.quality_trim(df, 30, 1).collect()] == [5, 3, 0]
    assert [r.kept_length for r in trim.quality_trim(df, 30, 1, "sum").collect()] == [2, 3, 0]


def test_fastq_round_trip(spark, tmp_path):
    from quillon.sources import fastq

    df = spark.createDataFrame([("r1", "ACGT", "@III"), ("r2", "GG", "!!")], "read_id string, seq string, qual string").coalesce(1)
    fastq.write_fastq(df, f"{tmp_path}/out")
    files = [str(p) for p in (tmp_path / "out").glob("*.gz")]
    assert sorted(tuple(r)[:3] for r in fastq.read_fastq(spark, files).collect()) == [("r1", "ACGT", "@III"), ("r2", "GG", "!!")]


def test_entry_works_without_the_optional_folders(tmp_path):
    """A copy without the subpackage, its tests and the pipeline still imports and lists the other queries."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    ask = "import __spark_entry__ as e; q = e.queries(); print(len(q), len([n for n in q if n.startswith('op')]), 'pipeline' in q, set(e.oracle_sql()) <= set(q))"
    for gone, expect in ((("quillon/llm", "corpus_pipeline.py"), (0, False)), (("corpus_pipeline.py",), (10, False)), (("quillon/llm",), (0, False))):
        copy = tmp_path / "-".join(g.replace("/", "_") for g in gone)
        shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "__pycache__"))
        had = True
        for g in gone:
            path = copy / g
            had = had and path.exists()
            shutil.rmtree(path) if path.is_dir() else path.unlink(missing_ok=True)
        if not had:
            continue  # the folders are already gone
        out = subprocess.run([sys.executable, "-c", ask], cwd=copy, env={**os.environ, "PYTHONPATH": str(copy)}, capture_output=True, text=True)
        assert out.returncode == 0, out.stderr
        n, ops, pipeline, known = out.stdout.split()[-4:]
        assert int(n) - int(ops) >= 120 and (int(ops), pipeline == "True") == expect and known == "True"

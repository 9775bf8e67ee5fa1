"""Tables of samples, conditions, reports and settings: sources and sinks."""

import os

from pyspark.sql import functions as F

METRICS = ["sample_id", "sample_name", "step", "metric", "value"]


def read_table(spark, path, required=()):
    """TSV, or CSV when that gives one column only or can't be read; raises when required columns are missing."""
    try:
        df = spark.read.csv(path, header=True, sep="\t")
        if len(df.columns) == 1:
            df = spark.read.csv(path, header=True)
    except Exception:
        df = spark.read.csv(path, header=True)
    missing = set(required) - set(df.columns)
    if missing:
        raise ValueError(f"{path}: missing columns {sorted(missing)}")
    return df


def first_of(df, keys, order=None):
    """The first row of each combination of keys, by the column order or else by place in the table."""
    place = F.monotonically_increasing_id() if order is None else F.col(order)
    rest = [c for c in df.columns if c not in keys]
    first = df.withColumn("_at", place).groupBy(*keys).agg(F.min_by(F.struct(*rest, F.col("_at")), "_at").alias("_row"))
    return first.select(*keys, *[f"_row.{c}" for c in rest]).select(df.columns)


def load_sample_sheet(spark, path, required=("sample_id", "sample_name"), dedupe_on=None):
    df = read_table(spark, path, required)
    return first_of(df, list(dedupe_on)) if dedupe_on else df


def samples_of(sheet):
    """Distinct trimmed (sample_id, sample_name); blank ones are dropped."""
    s = sheet.select(F.trim("sample_id").alias("sample_id"), F.trim("sample_name").alias("sample_name"))
    return s.where("sample_id <> '' and sample_name <> ''").distinct()


def one_sample(sheet, sample_id, strict=True):
    """The rows of one sample, its id compared as text; none is an error, unless not strict."""
    rows = sheet.where(F.col("sample_id").cast("string") == str(sample_id))
    if strict and rows.isEmpty():
        raise ValueError(f"no sample {sample_id}")
    return rows


def name_conflicts(sheet):
    """Sample ids with more than one name, and their names."""
    g = sheet.groupBy("sample_id").agg(F.array_sort(F.collect_set("sample_name")).alias("names")).where(F.size("names") > 1)
    return g.select("sample_id", F.array_join("names", ",").alias("names"))


def checked_names(sheet):
    """sheet, after a check that every sample id has one name."""
    bad = name_conflicts(sheet).limit(5).collect()
    if bad:
        raise ValueError(f"sample ids with more than one name: {[tuple(r) for r in bad]}")
    return sheet


def sample_names(sheet, order=None):
    """sample_id and its first name, both trimmed."""
    s = sheet.withColumns({c: F.trim(F.col(c).cast("string")) for c in ("sample_id", "sample_name")})
    keep = ["sample_id", "sample_name"] + ([order] if order else [])
    return first_of(s.select(keep), ["sample_id"], order).select("sample_id", "sample_name")


def condition_files(files, parse):
    """peptide, condition, file of a table of paths; of several files for one of them the last by name counts.

    parse: file name without its ending to (peptide, condition), such as label.parse_condition.
    """
    name = F.element_at(F.split("path", "/"), -1)
    peptide, condition = parse(F.regexp_replace(name, r"\.[^.]*$", ""))
    found = files.select(peptide.alias("peptide"), condition.alias("condition"), name.alias("name"), "path").where("condition is not null")
    return found.groupBy("peptide", "condition").agg(F.max_by("path", "name").alias("file"))


def list_files(spark, pattern):
    """Paths of the files that a glob pattern names."""
    return spark.read.format("binaryFile").load(pattern).select("path")


#: Lines of the barcode report and the metrics they hold.
UMI_REPORT = {
    "Total reads processed:": "total_reads",
    "Reads too short for spacer+UMI+anchor (dropped):": "dropped_too_short",
    "Reads with no anchor found (dropped):": "dropped_no_anchor",
    "Reads with anchor at invalid position (dropped):": "dropped_anchor_invalid",
    "Reads with empty insert after anchor (dropped):": "dropped_empty_insert",
    "Reads contributing to consensus UMIs:": "reads_consensus",
    "Reads in singleton UMIs:": "reads_singletons",
    "Total UMIs detected:": "total_umis",
    "UMIs with >= 2 reads (consensus):": "umis_ge2",
    "UMIs with 1 read (singletons kept):": "umis_singletons",
}
DROPPED = ("dropped_too_short", "dropped_no_anchor", "dropped_anchor_invalid", "dropped_empty_insert")


def umi_report(reports):
    """Metrics of barcode reports: sample and text to sample and one column a metric.

    A metric is the last whole number on the last line that holds its words; missing drop and read
    counts are 0. Adds the sums that follow from them.
    """
    lines = reports.select("sample", F.posexplode(F.split("text", "\n")).alias("at", "raw")).withColumn("line", F.trim(F.regexp_replace("raw", r"\s+", " "))).drop("raw")
    number = F.try_element_at(F.regexp_extract_all("line", F.lit(r"(\d+)"), 1), F.lit(-1)).cast("long")
    lines = lines.withColumn("number", number).where("number is not null")
    g = lines.groupBy("sample").agg(*[F.max_by(F.when(F.contains("line", F.lit(words)), F.col("number")), F.when(F.contains("line", F.lit(words)), F.col("at"))).alias(name) for words, name in UMI_REPORT.items()])
    g = g.na.fill(0, [*DROPPED, "reads_consensus", "reads_singletons"])
    g = g.withColumn("dropped_total", sum((F.col(c) for c in DROPPED), F.lit(0)).cast("long"))
    g = g.withColumn("kept_after_anchor", F.col("total_reads") - F.col("dropped_total"))
    return g.withColumn("reads_other_kept", F.col("kept_after_anchor") - F.col("reads_consensus") - F.col("reads_singletons"))


def stacked_summary(reports):
    """sample, block (metric or position), name, value of reports that stack a metric table and a position table.

    The metric block begins behind a line that starts with metric and ends at the next line of two
    names (digits may follow a letter); positions follow a line that starts with mutated_position_1based or fail_position_1based.
    Lines that begin with # and rows that are not a name and a whole number are left out.
    """
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x: F.trim(F.regexp_replace(x, "\r", ""))), lambda x: x != "")
    r = reports.select("sample", lines.alias("l"))
    places = lambda f: F.filter(F.transform("l", lambda x, i: F.when(f(x), i)), lambda i: i.isNotNull())
    r = r.withColumn("m", F.try_element_at(places(lambda x: F.lower(x).startswith("metric")), F.lit(1)))
    r = r.withColumn("heads", places(lambda x: x.rlike(r"^[A-Za-z_][A-Za-z0-9_]*\t[A-Za-z_]+$")))
    r = r.withColumn("stop", F.coalesce(F.try_element_at(F.filter("heads", lambda i: i > F.col("m")), F.lit(1)), F.size("l")))
    r = r.withColumn("p", F.try_element_at(places(lambda x: F.lower(x).rlike("^(mutated|fail)_position_1based")), F.lit(1)))
    e = r.select("sample", "m", "stop", "p", F.posexplode("l").alias("i", "line")).where("not startswith(line, '#')")
    e = e.withColumn("parts", F.split("line", r"\s+")).where(F.size("parts") == 2).withColumn("name", F.get("parts", F.lit(0))).withColumn("value", F.get("parts", F.lit(1)))
    e = e.where(F.col("value").rlike(r"^\d+$"))
    block = F.when((F.col("i") > F.col("m")) & (F.col("i") < F.col("stop")), "metric").when((F.col("i") > F.col("p")) & F.col("name").rlike(r"^\d+$"), "position")
    return e.withColumn("block", block).where("block is not null").select("sample", "block", "name", F.col("value").cast("long").alias("value"))


def write_table(df, path, sep="\t", partition_by=(), order=()):
    """Text files with a header; sorted within files, one folder a value of partition_by."""
    out = df.sortWithinPartitions(*order) if order else df
    writer = out.write.option("header", True).option("sep", sep)
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)


def append_metrics(metrics, path):
    """Adds rows to a metrics table (METRICS columns); Spark's commit keeps writers apart, so several may append."""
    metrics.select(*[c for c in METRICS[:-1]], F.col("value").cast("double").alias("value")).write.mode("append").option("header", True).option("sep", "\t").csv(path)


def read_metrics(spark, path):
    return spark.read.schema("sample_id string, sample_name string, step string, metric string, value double").option("header", True).option("sep", "\t").csv(path)


def write_pass_fail(rows, path, reason="fail_reason", keep_fails=True):
    """Rows without a reason below pass/, those with one below fail/; both as Parquet."""
    rows.where(F.col(reason).isNull()).drop(reason).write.parquet(f"{path}/pass")
    if keep_fails:
        rows.where(F.col(reason).isNotNull()).write.parquet(f"{path}/fail")


def report_text(counts, keys, title="Sample"):
    """One text a row: a title line and a line for every other column, in order."""
    names = [c for c in counts.columns if c not in keys]
    lines = [F.concat(F.lit(f"{title}: "), F.concat_ws("_", *[F.col(k).cast("string") for k in keys]))]
    lines += [F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in names]
    return counts.select(*keys, F.concat_ws("\n", *lines).alias("text"))


def load_config(path, required=(), defaults=None, path_keys=()):
    """Settings of a YAML file: required keys, defaults, and paths with variables, ~ and the file's folder resolved."""
    import yaml

    path = os.path.realpath(os.path.expanduser(path))
    with open(path, encoding="utf-8") as f:
        found = yaml.safe_load(f) or {}
    if not isinstance(found, dict):
        raise ValueError(f"{path}: settings must be a mapping")
    missing = [k for k in required if k not in found]
    if missing:
        raise ValueError(f"{path}: missing settings {missing}")
    out = {**(defaults or {}), **found}
    for k in path_keys:
        if isinstance(out.get(k), str) and out[k].strip():
            out[k] = os.path.join(os.path.dirname(path), os.path.expanduser(os.path.expandvars(out[k].strip())))
    return {**out, "_config_path": path, "_config_dir": os.path.dirname(path)}


def sample_configs(sheet, settings):
    """sample_id and the YAML text of its settings: the shared ones, its name and its files."""
    import yaml

    shared = yaml.safe_dump(settings, sort_keys=True)
    quoted = lambda c: F.concat(F.lit("'"), F.replace(F.col(c), F.lit("'"), F.lit("''")), F.lit("'"))
    g = sheet.groupBy("sample_id").agg(F.min("sample_name").alias("sample_name"), F.array_sort(F.collect_set(quoted("fastq"))).alias("files"))
    text = F.concat(F.lit(shared + "sample_id: "), quoted("sample_id"), F.lit("\nsample_name: "), quoted("sample_name"), F.lit("\nfastq:\n"), F.array_join(F.transform("files", lambda f: F.concat(F.lit("- "), f)), "\n"), F.lit("\n"))
    return g.select("sample_id", text.alias("yaml"))

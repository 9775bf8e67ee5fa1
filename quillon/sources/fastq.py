"""FASTQ source and sink, sample sheets, tolerant tables."""

import gzip

from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

NAME = r"^([A-Z0-9-]+)_(\d+)_\d+_(.+?)_S\d+_L(\d+)_R(\d+)_\d+\.fastq\.gz$"


class _File(InputPartition):
    def __init__(self, path):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, paths):
        self.paths = paths

    def partitions(self):
        return [_File(p) for p in self.paths]

    def read(self, partition):
        path = partition.path.removeprefix("file://").removeprefix("file:")
        opened = gzip.open(path, "rt") if path.endswith(".gz") else open(path)
        with opened as f:
            while head := f.readline():
                seq, plus, qual = (f.readline().rstrip("\r\n") for _ in range(3))
                if head[:1] != "@" or plus[:1] != "+" or len(seq) != len(qual):
                    raise ValueError(f"{path}: not a four-line record at {head.strip()!r}")
                yield head[1:].split()[0] if head[1:].split() else "", seq, qual, path


class FastqDataSource(DataSource):
    """spark.read.format("fastq").option("paths", comma-joined files): one partition a file."""

    @classmethod
    def name(cls):
        return "fastq"

    def schema(self):
        return "read_id string, seq string, qual string, file string"

    def reader(self, schema):
        return _Reader([p for p in self.options.get("paths", self.options.get("path", "")).split(",") if p])


def read_fastq(spark, paths):
    spark.dataSource.register(FastqDataSource)
    return spark.read.format("fastq").option("paths", ",".join(paths)).load()


def write_fastq(reads, path):
    """Gzip text of four-line records, one file a partition."""
    reads.select(F.concat_ws("\n", F.concat(F.lit("@"), "read_id"), "seq", F.lit("+"), "qual").alias("value")).write.option("compression", "gzip").text(path)


def sample_sheet(paths, path="path", run_depth=True):
    """sample_id, sample_name, run_depth, lane, read, fastq of FASTQ paths; sample_id is null where the name does not fit.

    run_depth is the first folder named like one, else null; without it, it is empty.
    """
    file = F.element_at(F.split(path, "/"), -1)
    part = lambda i: F.nullif(F.regexp_extract(file, NAME, i), F.lit(""))
    folders = F.filter(F.split(path, "/"), lambda p: p.rlike(r"^run\d+-\d+M"))
    depth = F.try_element_at(folders, F.lit(1)) if run_depth else F.lit("")
    return paths.select(part(1).alias("sample_id"), part(3).alias("sample_name"), depth.alias("run_depth"), part(4).alias("lane"), part(5).alias("read"), F.col(path).alias("fastq"))


def sheet_order():
    return [F.col(c).asc_nulls_first() for c in ("sample_id", "sample_name", "lane", "read")]


def collect_sample_sheet(spark, root, strict=True):
    """(sheet in order, paths that do not fit). No file at all that fits is an error, unless not strict."""
    every = sample_sheet(list_fastq(spark, root), run_depth=strict)
    sheet, odd = every.where("sample_id is not null"), every.where("sample_id is null").select("fastq")
    if strict and sheet.isEmpty():
        raise ValueError(f"no FASTQ name below {root} fits")
    return sheet.orderBy(*sheet_order(), "fastq"), odd


def read_pairs(sheet):
    """sample_id, sample_name, lane, r1, r2: the files of both reads, r2 null where it is missing."""
    keys = ["sample_id", "sample_name", "lane"]
    one, two = (sheet.where(F.col("read") == str(i)).groupBy(*keys).agg(F.min("fastq").alias(f"r{i}")) for i in (1, 2))
    return one.join(two, keys, "left")


def list_fastq(spark, root):
    """Paths of the gzip FASTQ files below root."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.fastq.gz").load(root).select("path")

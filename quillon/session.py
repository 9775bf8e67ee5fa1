"""What every query needs from its session: shared storage and the package on the workers."""

import os
import tempfile
import uuid
import zipfile

_shipped = set()


def ship_package(spark):
    """Send this package to the Python workers once per application, so they need no install."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="quillon-pkg-"), "quillon.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("quillon", os.path.relpath(path, root)))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def shared_dir(spark):
    """The folder of spark.checkpoint.dir, which driver and executors share.

    Only where it is unset (local tests) is a folder made; on a cluster without the
    setting there is no safe default, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = jvm_dir.get() if jvm_dir.isDefined() else None
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="quillon-shared-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def work_path(spark, name):
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/quillon/{uuid.uuid4().hex}-{name}"


def materialize(df, name):
    """Write df to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.written_to = path
    return back


def discard(*tables):
    """Delete the files of tables that materialize returned, once nothing reads them any more."""
    for df in tables:
        spark = df.sparkSession
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.written_to)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

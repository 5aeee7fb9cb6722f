"""Readers.

* ``read_csv``: headered CSV with an explicit schema (no inference pass, no type drift
  caused by the data itself, e.g. zip ``01234`` stays a string).
* ``read_table``: a catalog table by name, or a Parquet path.
* ``read_scripts``: a corpus of job scripts as ``(job_name, script_text)``, one row per file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str, **options) -> DataFrame:
    opts = {"header": "true", "mode": "PERMISSIVE"}
    opts.update({k: str(v) for k, v in options.items()})
    return spark.read.schema(schema).options(**opts).csv(path)


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """Catalog table when the name is registered, otherwise a Parquet path."""
    if "/" not in name_or_path and spark.catalog.tableExists(name_or_path):
        return spark.read.table(name_or_path)
    return spark.read.parquet(name_or_path)


def read_scripts(spark: SparkSession, path: str, pattern: str = "*.py", named_by: str = "file") -> DataFrame:
    """Whole-file text of every script under ``path``; job name = path below the folder without its ending, so that files
    of one name in different folders stay different jobs. ``named_by="folder"``: the path of the file's folder
    instead, for corpora that keep each script in a folder of its own (``key=`` in front of a folder's name is dropped).

    Missing files simply do not appear (the corpus is whatever exists), which is the
    "skip missing scripts" behaviour of a job list, without a driver-side loop.
    """
    df = (
        spark.read.option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .text(path, wholetext=True)
        .select(F.col("value").alias("script_text"), F.col("_metadata.file_path").alias("script_path"))
    )
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    root = folder.getFileSystem(conf).makeQualified(folder).toUri().getRawPath().rstrip("/") + "/"
    below = F.expr("regexp_replace(script_path, '^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?', '')")
    below = F.when(below.startswith(root), below.substr(F.lit(len(root) + 1), F.length(below))).otherwise(F.regexp_extract(below, r"([^/]+)$", 1))
    if named_by == "folder":
        below = F.regexp_replace(F.regexp_replace(below, r"/[^/]*$", ""), r"(^|/)[^/=]+=", "$1")
    stem = _plain_path(below)
    if named_by == "folder":
        stem = _plain_path(stem)  # names of partition folders are escaped once more
    else:
        stem = F.regexp_replace(stem, r"\.[^./]+$", "")
    return df.select(stem.alias("job_name"), "script_path", "script_text")


def _plain_path(escaped):
    return F.url_decode(F.regexp_replace(escaped, r"\+", "%2B"))


def read_job_scripts(spark: SparkSession, jobs: dict[str, str]) -> DataFrame:
    """``(job_name, script_path, script_text)`` for a job list ``{job_name: script_path}``.

    Spark lists the scripts' folders (in parallel, without reading any file) and a join with the job list says which
    scripts there are; those that are not are skipped. The driver looks at each folder once.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path_of = jvm.org.apache.hadoop.fs.Path
    wanted, folders = [], {}
    for job, path in jobs.items():
        full = path_of(path)
        full = full.getFileSystem(conf).makeQualified(full)
        wanted.append((job, full.toUri().toString()))
        folders.setdefault(full.getParent().toString(), full.getParent())
    there = [name for name, f in folders.items() if f.getFileSystem(conf).exists(f)]
    schema = "job_name string, script_path string, script_text string"
    if not there:
        return spark.createDataFrame([], schema)
    # Paths are compared as URIs in one spelling: file:/x and file:///x are the same place.
    plain = lambda c: F.regexp_replace(c, "^([a-zA-Z][a-zA-Z0-9+.-]*):/+", "$1:/")
    names = spark.createDataFrame(wanted, "job_name string, script_path string").withColumn("script_path", plain(F.col("script_path")))
    listed = spark.read.format("binaryFile").load(there).select(plain(F.col("_metadata.file_path")).alias("script_path"))
    found = names.join(listed, "script_path", "left_semi")
    uris = [r.script_path for r in found.select("script_path").distinct().collect()]  # as many as the job list has, at most
    if not uris:
        return spark.createDataFrame([], schema)
    texts = spark.read.text([path_of(jvm.java.net.URI(u)).toString() for u in uris], wholetext=True).select(
        F.col("value").alias("script_text"), plain(F.col("_metadata.file_path")).alias("script_path"))
    return names.join(texts, "script_path").select("job_name", "script_path", "script_text")

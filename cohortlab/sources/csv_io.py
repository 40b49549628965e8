"""CSV tables in, text files out, word lists."""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NAME_AT_END = re.compile(r"(\w+)(\.csv)?$", re.ASCII)


def table_name_from_path(path: str) -> str:
    """Last run of word characters before an optional ``.csv`` at the end of
    the path; the whole path when there is none."""
    m = _NAME_AT_END.search(path)
    return m.group(1) if m else path


def read_csv_table(spark: SparkSession, path: str, name: str | None = None, *,
                   multi_line: bool = False, schema=None) -> DataFrame:
    """CSV with a header row -> DataFrame registered as a temp view.

    Columns stay text (no schema inference pass); the typed loaders parse
    them. ``multi_line`` reads quoted fields that span lines (note texts); it
    makes each file one task, so big inputs should come as many files.
    """
    reader = (spark.read.option("header", True).option("escape", '"')
              .option("multiLine", multi_line).option("mode", "FAILFAST"))
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    df.createOrReplaceTempView(name or table_name_from_path(path))
    return df


def write_csv_table(df: DataFrame, path: str, *, compression: str = "none", rows_per_file: int = 0) -> None:
    """Partitioned CSV with header (the counterpart of ``read_csv_table``).

    Big texts are better written with a ``compression`` (``read_csv_table`` knows
    it by the file names) and, as a compressed or multi-line file is read by one
    task, with at most ``rows_per_file`` rows in a file."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"').option("compression", compression)
       .option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", int(rows_per_file)).option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(path))


def write_text(df: DataFrame, path: str, single: bool = False) -> None:
    """Write a one-string-column DataFrame as text lines, replacing ``path``.

    Output stays partitioned (one part file per task). With ``single`` the
    part files, written by as many tasks, become one file at ``path`` in their order.
    """
    if len(df.columns) != 1:
        df = df.select(F.concat_ws(",", *[F.col(c).cast("string") for c in df.columns]).alias("value"))
    if not single:
        df.write.mode("overwrite").text(path)
        return
    parts = f"{path.rstrip('/')}.parts-{uuid.uuid4().hex[:12]}"
    df.write.text(parts)
    merge_files(df.sparkSession, parts, path)


def merge_files(spark: SparkSession, folder: str, path: str) -> int:
    """The part files of ``folder`` as one file ``path`` (an old one is
    deleted first), in the order of their names; the folder goes. File systems that
    can concatenate do it without copying; elsewhere the bytes are streamed.
    Returns the number of parts."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    source, target = jvm.org.apache.hadoop.fs.Path(folder), jvm.org.apache.hadoop.fs.Path(path)
    fs = source.getFileSystem(conf)
    parts = sorted((f.getPath() for f in fs.listStatus(source) if f.getPath().getName().startswith("part-")),
                   key=lambda p: p.getName())
    fs.delete(target, True)
    if target.getParent() is not None:
        fs.mkdirs(target.getParent())
    full = [p for p in parts if fs.getFileStatus(p).getLen() > 0]
    try:
        if len(full) > 1:
            rest = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(full) - 1)
            for i, p in enumerate(full[1:]):
                rest[i] = p
            fs.concat(full[0], rest)
        done = bool(full) and fs.rename(full[0], target)
    except (Py4JJavaError, UnsupportedOperationException) as e:      # PySpark converts some
        if isinstance(e, Py4JJavaError) and "UnsupportedOperationException" not in str(e.java_exception):
            raise
        done = False
    if not done:
        out = fs.create(target, True)
        try:
            for p in full:
                part = fs.open(p)
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, conf, False)
                finally:
                    part.close()
        finally:
            out.close()
    fs.delete(source, True)
    return len(parts)


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """One word per line -> distinct words, column ``word``."""
    return spark.read.text(path).select(F.col("value").alias("word")).distinct()

"""S1: reading raw transaction text.

``read_raw_csv`` reads files of one known layout and raises on any other.
``read_csv_by_header`` finds columns by name in every file's own header, so
files whose columns are permuted, missing or additional are read together.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import RAW_SCHEMA

BROKEN = "broken_record"


def read_raw_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = RAW_SCHEMA,
    infer_schema: bool = False,
    multiline: bool = False,
    **options: str,
) -> DataFrame:
    """Header CSV, every column read as text (empty field -> null; the text
    ``NULL`` stays text).

    Reading with an explicit all-text schema avoids an inference pass over the
    files and keeps leading zeros and odd formats for the cleaners.
    ``infer_schema=True`` reproduces type inference when wanted.  A file whose
    header does not have the schema's columns in the schema's order raises when
    it is read (a schema is applied by position, so it would swap columns):
    use :func:`read_csv_by_header` for such files.
    """
    r = spark.read.option("header", True).option("multiLine", multiline).option("enforceSchema", False)
    for k, v in options.items():
        r = r.option(k, v)
    if infer_schema:
        r = r.option("inferSchema", True)
    elif schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def csv_headers(spark: SparkSession, path: str | Sequence[str], separator: str = ",", quote: str = '"', encoding: str = "UTF-8") -> dict[tuple[str, ...], list[str]]:
    """Every layout found under the paths: the header's names, and the files that have it; empty files are left out.

    Files are listed by Spark, and only the first line of each is read, a few
    files at a time, through the Hadoop file system (any store, compressed files too).
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    files = [r["path"] for r in spark.read.format("binaryFile").load(path if isinstance(path, str) else list(path)).select("path").collect()]

    def header(file: str) -> tuple[str, ...] | None:
        at = jvm.org.apache.hadoop.fs.Path(file)
        stream = at.getFileSystem(conf).open(at)
        try:
            codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at)
            lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, encoding))
            line = lines.readLine()
            while line is not None and not line.strip():
                line = lines.readLine()
        finally:
            stream.close()
        return None if line is None else tuple(n.strip().lstrip("\ufeff") for n in next(csv.reader([line], delimiter=separator, quotechar=quote)))

    with ThreadPoolExecutor(16) as pool:
        found = list(pool.map(header, files))
    layouts: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for names, file in sorted((h, f) for h, f in zip(found, files) if h is not None):
        layouts[names].append(file)
    return dict(layouts)


def read_csv_by_header(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType = RAW_SCHEMA,
    broken: str | None = BROKEN,
    separator: str = ",",
    quote: str = '"',
    encoding: str = "UTF-8",
    **options: str,
) -> DataFrame:
    """The columns of ``schema`` from files with any headers, found by name (upper and lower case alike).

    Files of one layout are one scan; the scans are united by name, so there is
    a scan for each different header, not for each file.  A column that a file
    lacks is null there; a column that the schema lacks is not read.  Values
    are cast to the schema's types (null if they do not fit).  ``broken`` names
    one more column, with the text of every record that has more or fewer fields than its
    file's header, else null (``None``: no such column).  A file without any
    column of the schema, or with one of them twice, raises; no files, or empty ones alone,
    give an empty table.
    """
    wanted = {f.name.lower(): f for f in schema.fields}
    out = T.StructType(schema.fields + ([T.StructField(broken, T.StringType())] if broken else []))
    parts = []
    for names, files in csv_headers(spark, path, separator, quote, encoding).items():
        lower = [n.lower() for n in names]
        place = {n: i for i, n in enumerate(lower) if n in wanted}
        if not place:
            raise ValueError(f"{files[0]}: the header has none of the wanted columns: {', '.join(names)}")
        twice = sorted(n for n in place if lower.count(n) > 1)
        if twice:
            raise ValueError(f"{files[0]}: the header has {', '.join(twice)} more than once")
        # Read by position under names of our own: a header may repeat names that are not wanted.
        read = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))] + [T.StructField("broken", T.StringType())])
        r = spark.read.schema(read).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "broken")
        r = r.option("columnPruning", broken is None)  # a record is broken by its fields, whichever columns are asked for
        r = r.option("sep", separator).option("quote", quote).option("encoding", encoding)
        for k, v in options.items():
            r = r.option(k, v)
        value = lambda f: F.col(f"c{place[f.name.lower()]}") if f.name.lower() in place else F.lit(None)  # noqa: E731, B023
        columns = [value(f).try_cast(f.dataType).alias(f.name) for f in schema.fields]
        # Spark refuses to read the text of broken records alone: the condition, always true, reads one more column.
        text = F.when(F.coalesce("c0", F.lit("")) != F.lit("\0"), F.col("broken"))
        parts.append(r.csv(files).select(*columns, *([text.alias(broken)] if broken else [])))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], out)


def write_raw_csv(df: DataFrame, path: str) -> None:
    """Write text columns as header CSV for ``read_raw_csv``: edge whitespace is kept;
    nulls and empty strings both come back as null."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )

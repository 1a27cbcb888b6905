"""Text sinks for exports and series."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.sources.tables import drop_path, hadoop_path, names_in, staging_path


def csv_columns(df: DataFrame) -> DataFrame:
    """Dates as ``yyyy-MM-dd`` text, everything else as it is."""
    return df.select(
        *(
            F.date_format(f.name, "yyyy-MM-dd").alias(f.name) if isinstance(f.dataType, T.DateType) else F.col(f.name)
            for f in df.schema.fields
        )
    )


def write_csv(df: DataFrame, path: str) -> None:
    """``;``-separated files with a header; nulls become empty fields."""
    csv_columns(df).write.mode("overwrite").option("sep", ";").option("header", True).option("nullValue", "").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per row, null fields kept."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def json_rows(df: DataFrame, name: str = "json") -> DataFrame:
    """The rows as JSON text in one column."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias(name))


_END = "\r\n"


def number_text(value: Column) -> Column:
    """A double as text: shortest digits, a point always, an exponent only below 1e-4 and from 1e16 on."""
    plain = F.regexp_replace(F.regexp_replace(value.cast("string").cast("decimal(38,18)").cast("string"), "0+$", ""), r"\.$", ".0")
    size = F.abs(value)
    exponent = F.regexp_replace(F.regexp_replace(value.cast("string"), r"\.0E", "E"), "E(-?)([0-9])$", "E$10$2")
    exponent = F.regexp_replace(F.regexp_replace(exponent, "E-", "e-"), "E", "e+")
    special = F.when(F.isnan(value), F.lit("nan")).when(value == float("inf"), F.lit("inf")).when(value == float("-inf"), F.lit("-inf"))
    usual = F.when((size == 0) | ((size >= 1e-3) & (size < 1e7)), value.cast("string"))
    return F.coalesce(special, usual.when((size >= 1e-4) & (size < 1e16), plain).otherwise(exponent))


def csv_line(df: DataFrame, separator: str = ";") -> Column:
    """A row as one CSV line: missing values empty, texts in quotes only where they hold a separator, quote or line break."""

    def cell(f: T.StructField) -> Column:
        value = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            value = number_text(value.cast("double"))
        elif isinstance(f.dataType, T.DateType):
            value = F.date_format(value, "yyyy-MM-dd")
        else:
            value = value.cast("string")
            quoted = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
            value = F.when(F.regexp_like(value, F.lit(f'[{separator}"\r\n]')), quoted).otherwise(value)
        return F.coalesce(value, F.lit(""))

    return F.concat_ws(separator, *[cell(f) for f in df.schema.fields])


def write_csv_file(df: DataFrame, path: str, order: Sequence[str], separator: str = ";", parts: int | None = None) -> None:
    """One CSV file with one header, rows in the order of ``order``, lines ending in CR LF.

    Rows are dealt by ranges of ``order`` and every task writes its own sorted part, without a header; the header is a part of its
    own. The file system then joins the parts in their order: by moving blocks where it can do that (``concat``),
    else by copying part after part through a fixed buffer. The file appears under its name when it is whole.
    """
    spark = df.sparkSession
    stage = staging_path(path)
    ranged = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    lines = ranged.sortWithinPartitions(*order).select(csv_line(df, separator).alias("value"))
    header = spark.createDataFrame([(separator.join(df.columns),)], "value string").coalesce(1)
    try:
        header.write.option("lineSep", _END).text(f"{stage}/header")
        lines.write.option("lineSep", _END).text(f"{stage}/rows")
        found = [f"{stage}/{d}/{n}" for d in ("header", "rows") for n in sorted(names_in(spark, f"{stage}/{d}")) if n.startswith("part-")]
        _join(spark, found, f"{stage}/whole")
        fs, target = hadoop_path(spark, path)
        fs.delete(target, False)
        fs.mkdirs(target.getParent())
        if not fs.rename(hadoop_path(spark, f"{stage}/whole")[1], target):
            raise OSError(f"could not rename the finished file to {path}")
    finally:
        drop_path(spark, stage)


def _join(spark: SparkSession, parts: list[str], target: str) -> None:
    """Parts one after another as one file."""
    fs, whole = hadoop_path(spark, target)
    paths = [hadoop_path(spark, p)[1] for p in parts]
    jvm = spark._jvm
    rest = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(paths) - 1)
    for i, p in enumerate(paths[1:]):
        rest[i] = p
    try:
        if len(paths) > 1:
            fs.concat(paths[0], rest)
        fs.rename(paths[0], whole)
        return
    except (Py4JJavaError, PySparkException) as e:
        if "UnsupportedOperation" not in f"{type(e).__name__} {e}":
            raise
    out = fs.create(whole, True)
    try:
        for p in paths:
            source = fs.open(p)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, spark._jsc.hadoopConfiguration(), False)
            finally:
                source.close()
    finally:
        out.close()

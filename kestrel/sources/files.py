"""File connectors: quoted CSV, whitespace-positional text, taxonomy lines
with unquoted commas, wide files with dates in the header, and audited uploads.  Readers
take explicit schemas or the header (no inference pass) and coerce with try_* functions so bad
values become NULL instead of failing."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kestrel.session import remove_folder


def write_panel_csv(df: DataFrame, path: str) -> None:
    """d, id, ret (scientific notation), price (empty when missing) and a
    name field with embedded quotes and commas; CRLF line ends."""
    out = df.select(
        F.date_format("d", "yyyy-MM-dd").alias("d"), F.col("id").cast("string").alias("id"),
        F.format_string("%.6E", F.col("ret")).alias("ret"),
        F.coalesce(F.format_string("%.4f", F.col("price")), F.lit("")).alias("price"),
        F.concat(F.lit('Supplier "'), F.col("id").cast("string"), F.lit('", inc')).alias("name"))
    (out.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"')
        .option("lineSep", "\r\n").option("emptyValue", "").csv(path))


def read_panel_csv(spark: SparkSession, path: str) -> DataFrame:
    raw = (spark.read.schema("d string, id string, ret string, price string, name string")
           .option("header", True).option("quote", '"').option("escape", '"').option("lineSep", "\r\n").csv(path))
    return raw.select(F.try_to_date(F.trim("d"), "yyyy-MM-dd").alias("d"), F.expr("try_cast(trim(id) AS BIGINT)").alias("id"),
                      F.expr("try_cast(trim(ret) AS DOUBLE)").alias("ret"),
                      F.expr("try_cast(nullif(trim(price), '') AS DOUBLE)").alias("price"), "name")


def write_whitespace(df: DataFrame, path: str) -> None:
    """Headerless, fields separated by runs of spaces, '.' for missing."""
    cols = [F.coalesce(F.col(c).cast("string"), F.lit(".")) for c in df.columns]
    line = F.concat_ws("   ", *cols)
    df.select(F.concat(F.lit(" "), line).alias("value")).write.mode("overwrite").text(path)


def read_whitespace(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Fields by position, typed by the DDL ``schema``; '.', a missing field of a
    short line and a value that doesn't fit its type become NULL."""
    t = spark.read.text(path).select(F.split(F.trim("value"), r"\s+").alias("f"))
    fields = StructType.fromDDL(schema).fields
    return t.select(*[F.nullif(F.get("f", F.lit(i)), F.lit(".")).try_cast(c.dataType).alias(c.name) for i, c in enumerate(fields)])


def write_taxonomy(edges: DataFrame, path: str) -> None:
    """id_cat,parent,child,description -- description holds unquoted commas;
    every tenth line is short (no description); one 'None' parent line."""
    from pyspark.sql import Window
    e = edges.withColumn("id_cat", F.row_number().over(Window.orderBy("parent", "child")))  # taxonomy-sized
    desc = F.concat(F.lit("node "), F.col("child"), F.lit(", level, and more"))
    line = F.when(F.col("id_cat") % 10 == 0, F.concat_ws(",", F.col("id_cat").cast("string"), "parent", "child")) \
            .otherwise(F.concat_ws(",", F.col("id_cat").cast("string"), "parent", "child", desc))
    extra = edges.sparkSession.createDataFrame([("0,None,Root,root node, top",)], "value string")
    e.select(line.alias("value")).unionByName(extra).write.mode("overwrite").text(path)


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    t = spark.read.text(path).select(F.split("value", ",", 4).alias("f"))
    g = lambda i: F.trim(F.coalesce(F.get(F.col("f"), i), F.lit("")))
    return t.select(F.expr("try_cast(trim(f[0]) AS INT)").alias("id_cat"), g(1).alias("parent"), g(2).alias("child"),
                    g(3).alias("description"))


def write_wide_dates(df: DataFrame, id_col: str, date: str, value: str, path: str) -> None:
    """One row per id and one column per date that occurs, dates as headers.  A cell is
    the value of its only row; cells without a row are empty."""
    cells = df.select(id_col, F.date_format(date, "yyyy-MM-dd").alias("_d"), value)
    cells.groupBy(id_col).pivot("_d").agg(F.first(value)).write.mode("overwrite").option("header", True).csv(path)


def read_wide_dates(spark: SparkSession, path: str, date: str = "t", value: str = "y", header: str = r"\d{4}-\d{2}-\d{2}") -> DataFrame:
    """(other columns..., date, value): the date columns are those whose header matches
    ``header`` and is a date; empty cells and cells that are no numbers give no row.  A
    file without date columns gives no rows."""
    wide = spark.read.option("header", True).csv(path)
    dates = [c for c in wide.columns if re.fullmatch(header, c)]
    kept = [c for c in wide.columns if c not in dates]
    if not dates:
        return wide.withColumns({date: F.lit(None).cast("date"), value: F.lit(None).cast("double")}).where("false")
    quoted = [F.col("`" + c.replace("`", "``") + "`") for c in dates]
    long = wide.unpivot([F.col("`" + c.replace("`", "``") + "`") for c in kept], quoted, date, value)
    typed = long.withColumns({date: F.try_to_date(date, "yyyy-MM-dd"), value: F.col(value).try_cast("double")})
    return typed.where(F.col(date).isNotNull() & F.col(value).isNotNull())


def stage_upload(df: DataFrame, path: str) -> tuple[str, DataFrame]:
    """Writes ``df`` as Parquet to a new folder beside ``path``; (folder, what was written, read back)."""
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    df.write.parquet(staged)
    return staged, df.sparkSession.read.schema(df.schema).parquet(staged)


def commit_upload(df: DataFrame, path: str, audit: Callable[[DataFrame], DataFrame]) -> Row:
    """Staged write: ``df`` is written beside ``path``, read back and audited there, and renamed to
    ``path`` if the one row of ``audit`` has status PASS.  Otherwise, or if there already is
    something at ``path``, the staged folder goes and the call fails.  Returns the audit row."""
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    staged, written = stage_upload(df, path)
    try:
        row = audit(written).first()
        if row["status"] != "PASS":
            raise ValueError(f"upload refused: {row.asDict()}")
        fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(hadoop.Path(path)) or not fs.rename(hadoop.Path(staged), hadoop.Path(path)):
            raise FileExistsError(path)
    except Exception:
        remove_folder(spark, staged)
        raise
    return row

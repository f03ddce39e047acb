"""Reading and writing files: text, delimited lines, vectors, records, JSON, stored copies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.text import remove_quotes


def inline_rows(spark: SparkSession, rows: list, schema: str | StructType, partitions: int) -> DataFrame:
    """Driver-side rows with a declared schema, spread over ``partitions``."""
    return spark.createDataFrame(rows, schema).repartition(partitions)


def inferred_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Driver-side rows whose schema Spark infers from the values."""
    return spark.createDataFrame([Row(**r) for r in rows])


def apply_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema``, cast to its types; a null in a non-null column stops the job."""
    columns = []
    for field in schema.fields:
        c = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            message = F.lit(f"null in non-null column {field.name}")
            c = F.when(c.isNull(), F.raise_error(message).cast(field.dataType)).otherwise(c)
        columns.append(c.alias(field.name))
    return df.select(*columns)


def text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line in ``value``; split sizes follow spark.sql.files.maxPartitionBytes."""
    return spark.read.text(path)


def parquet_roundtrip(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished Spark output lies at ``path``, on whichever file system it names."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)


def materialise_or_load(spark: SparkSession, path: str, compute: Callable[[], DataFrame]) -> DataFrame:
    """The stored copy if a finished one is there, else compute, store and read it."""
    if not path_exists(spark, path):
        compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def csv_with_header(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Typed CSV, header skipped; no inference pass over the data. A bad value stops the job."""
    return (
        spark.read.option("header", True).option("mode", "FAILFAST").schema(schema).csv(path)
    )


def features_and_label(df: DataFrame) -> DataFrame:
    """All columns but the last as an array, the last as the label."""
    *inputs, label = df.columns
    return df.select(
        F.array(*[F.col(c).cast("double") for c in inputs]).alias("features"),
        F.col(label).alias("label"),
    )


# One field of a delimited line: quoted, where a doubled quote stands for one and commas are text, or plain.
# Possessive, so a long or broken line is read once and never tried again.
_FIELD = r'(?:"(?:[^"]++|"")*+"|[^",]*+)'
_LINE = f"^{_FIELD}(?:,{_FIELD})*+$"


def quoted_fields(line: Column) -> Column:
    """The fields of a delimited line, outer quotes off and doubled quotes single; null for a broken line: a quote
    that is never closed, or text beside a quoted field."""
    fields = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(f",({_FIELD})"), 1)
    plain = F.transform(fields, lambda x: F.when(
        x.startswith('"'), F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x))
    return F.when(line.rlike(_LINE), plain)


def delimited_status(lines: DataFrame, n_fields: int, header: str, required: list[int]) -> DataFrame:
    """Delimited lines sorted into three outcomes: (value, status, fields).

    0 is a header, known by its first field; 1 a valid line, with ``n_fields`` fields of which the ``required`` ones
    (from 0) are not empty; -1 any other, which has no fields but keeps its ``value``.
    """
    # explode of one item: the line is cut once, however often its fields are named
    cut = lines.select("value", F.explode(F.array(quoted_fields(F.col("value")))).alias("cut"))
    filled = F.size("cut") == n_fields
    for i in required:
        filled = filled & (F.get("cut", F.lit(i)) != "")
    status = F.when(F.get("cut", F.lit(0)) == header, 0).when(filled, 1).otherwise(-1)
    return cut.select("value", status.alias("status"), F.when(status == 1, F.col("cut")).alias("fields"))


def product_status(lines: DataFrame, header: str = "id") -> DataFrame:
    """Lines ``"id","name","description","manufacturer",price``: (value, status, id, text), the text joined from the
    three fields in the middle, quotes taken out. Id and name must be there."""
    parsed = delimited_status(lines, 5, header, [0, 1])
    return parsed.select(
        "value", "status", remove_quotes(F.col("fields")[0]).alias("id"),
        F.when(F.col("status") == 1, remove_quotes(F.array_join(F.slice("fields", 2, 3), " "))).alias("text"),
    )


def gold_status(lines: DataFrame, header: str = "idLeft") -> DataFrame:
    """Lines ``"left id","right id"`` of known duplicates: (value, status, left_id, right_id), quotes taken out."""
    parsed = delimited_status(lines, 2, header, [0, 1])
    return parsed.select(
        "value", "status", remove_quotes(F.col("fields")[0]).alias("left_id"), remove_quotes(F.col("fields")[1]).alias("right_id")
    )


def rejects(parsed: DataFrame, n: int) -> DataFrame:
    """The first ``n`` broken lines in order of their text: each task keeps n at most."""
    return parsed.where("status = -1").select("value").orderBy("value").limit(n)


def numeric_matrix(lines: DataFrame) -> DataFrame:
    """Blank-separated numbers per line as array<double>; a piece that is no number stops the job."""
    return lines.select(F.split(F.trim("value"), r"\s+").cast("array<double>").alias("row"))


def tagged_multi_file(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines of several files with split and label read from the names, as in ``train-pos.txt``."""
    tag = r"(train|test)[-_](pos|neg)[^/]*(?:/[^/]*)?$"
    path = F.col("_metadata.file_path")
    return spark.read.text(paths).select(
        F.col("value").alias("text"),
        F.regexp_extract(path, tag, 1).alias("split"),
        F.when(F.regexp_extract(path, tag, 2) == "pos", 1).otherwise(0).alias("label"),
    )


def question_files(spark: SparkSession, path: str, record_end: str | None = None) -> DataFrame:
    """Question records: (url, status, context, question, answer, candidates). The context is on line 3, the question
    on 5, the answer on 7, candidates from 9 on, each cut at its colon.

    A record of fewer than seven lines has the status ``short``, its url, and nulls; others are ``ok``. One record
    per file, or many per file with ``record_end`` between them: at scale a file per record means a task's worth of
    overhead per record.
    """
    reader = spark.read.option("lineSep", record_end) if record_end else spark.read
    raw = reader.text(path, wholetext=record_end is None)
    # explode of one item keeps the split from being repeated in every column
    lines = raw.select(F.explode(F.array(F.split("value", "\n"))).alias("line"))
    whole = F.size("line") >= 7

    def at(i: int) -> Column:
        return F.when(whole, F.get("line", F.lit(i - 1)))

    named = F.filter(F.slice("line", 9, F.greatest(F.size("line") - 8, F.lit(0))), lambda x: x != "")
    return lines.select(
        F.trim(F.get("line", F.lit(0))).alias("url"),
        F.when(whole, "ok").otherwise("short").alias("status"),
        at(3).alias("context"),
        at(5).alias("question"),
        at(7).alias("answer"),
        F.when(whole, F.transform(named, lambda x: F.substring_index(x, ":", 1))).alias("candidates"),
    )


def word_vector_file(lines: DataFrame) -> DataFrame:
    """``word v1 v2 ..`` lines to (word, vec)."""
    parts = F.split("value", " ")
    return lines.select(
        parts[0].alias("word"), F.slice(parts, 2, F.size(parts) - 1).cast("array<double>").alias("vec")
    )


def json_sink(df: DataFrame, path: str) -> None:
    """One JSON document per row."""
    df.write.json(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """The table over all cores, where it is stored in fewer splits than there are cores.

    Text work is bound by CPU, and one big row group would keep it on one core. A table of many
    splits, as on a cluster, stays as it is and is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df

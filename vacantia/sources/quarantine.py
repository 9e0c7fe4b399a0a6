"""Lines of feeds that can't be read are set apart with file and reason, and files are told apart by what they hold.

A line is good if it is a JSON object of which some field of the schema can be read. Reasons: ``empty`` (null or blank),
``not json``, ``no object``, ``no field``, ``wrong type`` (a field that the schema can't hold).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

GOOD, BAD = "good", "quarantined"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line) of text files; a glob may name several."""
    return spark.read.text(path).select(F.input_file_name().alias("file"), F.col("value").alias("line"))


def judged(lines: DataFrame, schema: T.StructType, line: str = "line") -> DataFrame:
    """The columns of ``lines``, what was read (``parsed``), and why a line was not (``reason``, null if it was)."""
    body = F.trim(F.col(line))
    names = [f.name for f in schema.fields]
    permissive = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    read = F.from_json(body, T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())]), permissive)
    some: Column = F.lit(False)
    for name in names:
        some = some | F.col("_read")[name].isNotNull()
    shape = F.try_parse_json(body)
    reason = (
        F.when(F.coalesce(body, F.lit("")) == "", "empty")
        .when(F.col("_shape").isNull(), "not json")
        .when(~F.schema_of_variant("_shape").startswith("OBJECT"), "no object")
        .when(F.col("_read._corrupt").isNotNull(), "wrong type")
        .when(~some, "no field")
    )
    made = lines.withColumns({"_read": read, "_shape": shape})
    parsed = F.when(F.col("reason").isNull(), F.struct(*(F.col("_read")[n].alias(n) for n in names)))
    return made.withColumn("reason", reason).withColumn("parsed", parsed).drop("_read", "_shape")


def apart(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good lines as rows of the schema beside the other columns but the line; bad ones as they came, with the reason."""
    good = judged.where("reason is null").select(*(c for c in judged.columns if c not in ("line", "parsed", "reason")), "parsed.*")
    return good, judged.where("reason is not null").drop("parsed")


def write_apart(judged: DataFrame, folder: str, part: str) -> None:
    """Good and bad lines of a part (a day, a batch), each below its own folder; a part that runs again replaces its own."""
    good, bad = apart(judged)
    good.write.mode("overwrite").json(f"{folder}/{GOOD}/part={part}")
    bad.write.mode("overwrite").json(f"{folder}/{BAD}/part={part}")


def files(judged: DataFrame) -> DataFrame:
    """(file, good, bad, state): read, partly read, corrupt (nothing could be read), or empty (blank lines alone)."""
    full = F.expr("count_if(reason is not null and reason != 'empty')")
    counted = judged.groupBy("file").agg(F.expr("count_if(reason is null)").alias("good"), full.alias("bad"))
    state = F.when(F.expr("good > 0 and bad = 0"), "read").when(F.expr("good > 0"), "partly read").when(F.expr("bad > 0"), "corrupt").otherwise("empty")
    return counted.withColumn("state", state)

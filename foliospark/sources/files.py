"""Scans and sinks of JSON lines and binary files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from foliospark.functions.text import nfkc


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One row a line; blank lines are skipped, a malformed line is an error. The schema is stated, so no pass infers it."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """Overwrites; nulls are written, so that each line has every field."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def binaries(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path, name, suffix (lower case), content of the files below a folder."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return df.select("path", name.alias("name"), F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1)).alias("suffix"), "content")


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def data_url(content: Column, suffix: Column) -> Column:
    """The image as a data URL; no suffix: png."""
    kind = F.when(suffix == "jpg", "jpeg").when(F.coalesce(suffix, F.lit("")) == "", "png").otherwise(suffix)
    return F.concat(F.lit("data:image/"), kind, F.lit(";base64,"), F.regexp_replace(F.base64(content), r"\s", ""))


def slug(name: Column) -> Column:
    """Compatibility characters folded, runs of other than ASCII letters and digits to one underscore."""
    out = F.regexp_replace(F.regexp_replace(nfkc(name), "[^A-Za-z0-9]+", "_"), "^_|_$", "")
    return F.when(out == "", "document").otherwise(out)

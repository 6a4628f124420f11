"""Lookup tables and catalogues of competing sources from CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boundaryspark.functions import scalars as S
from boundaryspark.schema import COUNTRIES, LICENSES


def read_countries(spark: SparkSession, path: str) -> DataFrame:
    """Country list; claimants of disputed areas as an array."""
    df = spark.read.csv(path, header=True, schema=COUNTRIES, multiLine=False)
    return df.withColumn("claimants", S.claimants("Claimant(s)")).withColumn("iso", F.col("Alpha-3code"))


def read_licenses(spark: SparkSession, path: str) -> DataFrame:
    """Licence list, whose fields carry a leading blank; Yes and No become booleans."""
    df = spark.read.csv(path, header=True, schema=LICENSES, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True,
                        enforceSchema=True)
    flag = lambda c: F.lower(F.trim(c)) == "yes"
    texts = ["license_name", "licenseText"]
    return df.select(*texts, F.lower(F.trim("license_name")).alias("license"),
                     *[flag(c).alias(c) for c in LICENSES.names if c not in texts],
                     flag("gbOpen").alias("gb_open"), flag("gbAuthoritative").alias("gb_authoritative"),
                     flag("gbHumanitarian").alias("gb_humanitarian"))


def read_source_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV of sources to compare, all columns as text; blank rows are skipped."""
    df = spark.read.csv(path, header=True, inferSchema=False, quote='"', escape='"')
    filled = F.lit(False)
    for c in df.columns:
        filled = filled | (F.trim(F.coalesce(F.col(f"`{c}`"), F.lit(""))) != "")
    return df.filter(filled)

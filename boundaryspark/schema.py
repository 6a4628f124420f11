"""Spark types of the data model."""

from pyspark.sql import types as T

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RING = T.ArrayType(POINT)
POLYGON = T.ArrayType(RING)
GEOMETRY = T.ArrayType(POLYGON)  # polygons > rings > points, ring 0 is the shell

GEOMETRY_DDL = "array<array<array<struct<x:double,y:double>>>>"

COUNTRIES = T.StructType([T.StructField(n, T.StringType()) for n in (
    "Name", "LocationCode", "Alpha-3code", "Claimant(s)", "Disputed", "UNSDG-subregion",
    "UNSDG-region", "Continent", "worldBankIncomeGroup")])

LICENSES = T.StructType([T.StructField(n, T.StringType()) for n in (
    "license_name", "licenseText", "gbOpen", "gbAuthoritative", "gbHumanitarian", "lMustAttribute",
    "lMustShareAlike", "lRedistributionAllowed", "lMustIndicateChanges", "lSpecialUseRestrictions")])

LAYER_METADATA = T.StructType([T.StructField(n, T.StringType()) for n in (
    "boundaryID", "boundaryISO", "boundaryYear", "boundaryType", "boundarySource", "boundaryCanonical",
    "boundaryLicense", "licenseDetail", "licenseSource", "boundarySourceURL", "sourceDataUpdateDate",
    "buildDate", "admUnitCount", "meanVertices", "minVertices", "maxVertices", "meanPerimeterLengthKM",
    "maxPerimeterLengthKM", "minPerimeterLengthKM", "meanAreaSqKM", "minAreaSqKM", "maxAreaSqKM")])

TASKS = T.StructType([
    T.StructField("taskid", T.StringType()), T.StructField("iso", T.StringType()),
    T.StructField("adm", T.StringType()), T.StructField("time_added", T.TimestampType()),
    T.StructField("time_completed", T.TimestampType()), T.StructField("runtime", T.DayTimeIntervalType()),
    T.StructField("filesize", T.LongType()), T.StructField("status", T.StringType()),
    T.StructField("status_detail", T.StringType()), T.StructField("status_time", T.TimestampType())])

STATUS_EVENTS = T.StructType([
    T.StructField("status_type", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("ts", T.TimestampType()), T.StructField("source_date", T.TimestampType())])

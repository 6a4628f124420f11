"""Submitted zip packages and what is inside them."""

from __future__ import annotations

import io
import re
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boundaryspark.functions import scalars as S

MEMBER_SCHEMA = "package_id string, member string, size long, crc long, content binary"
UNREADABLE = "unreadable package"


def read_packages(spark: SparkSession, root: str) -> DataFrame:
    """One row per zip below the root; the bytes are read only where a job uses `content`."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.zip").load(root)
    return files.select(*describe_packages(F.col("path")), "path", "length", "modificationTime", "content")


def describe_packages(path: Column) -> list[Column]:
    parts = S.file_stem_parts(path)
    return [path.alias("package_id"), F.element_at(F.split(path, "/"), -2).alias("product"), parts["iso"].alias("iso"),
            parts["adm"].alias("adm"), parts["file_name"].alias("file_name")]


#: Bytes and number of members that are handed on at once.
MEMBER_BYTES = 16 << 20
MEMBERS_AT_ONCE = 10_000
META_FILE = r"meta\.txt"


def package_members(packages: DataFrame, unpack: str | None = ".*") -> DataFrame:
    """One row per member; a zip that can't be read gives one row that says so.

    Names, sizes and checksums come from the zip's directory.  Only members whose whole name matches `unpack` are read, by their place in the
    file, and have their bytes in `content`; with None no member is.
    """
    wanted = re.compile(unpack, re.DOTALL) if unpack is not None else None

    columns = ["package_id", "member", "size", "crc", "content"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0  # members of many small packages are handed on together
        for batch in batches:
            for package_id, content in zip(batch["package_id"], batch["content"]):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as archive:
                        infos = [i for i in archive.infolist() if not i.is_dir() and "__MACOSX" not in i.filename]
                        # a broken member makes the package unreadable, so it shows before any row is handed on
                        read = [archive.read(i) if wanted and wanted.fullmatch(i.filename) else None for i in infos]
                    rows = [(package_id, i.filename, i.file_size, i.CRC, data) for i, data in zip(infos, read, strict=True)]
                except (zipfile.BadZipFile, zlib.error, NotImplementedError, RuntimeError, EOFError):
                    rows = [(package_id, UNREADABLE, None, None, None)]
                for row in rows:
                    held.append(row)
                    size += len(row[4] or b"")
                    if size >= MEMBER_BYTES or len(held) >= MEMBERS_AT_ONCE:
                        yield pd.DataFrame(held, columns=columns)
                        held, size = [], 0
        if held:
            yield pd.DataFrame(held, columns=columns)
    return packages.select("package_id", "content").mapInPandas(run, MEMBER_SCHEMA)


def meta_texts(members: DataFrame) -> DataFrame:
    """package_id, path and text of the metadata file in the root of each package."""
    return members.filter(F.col("member") == "meta.txt").select(
        "package_id", F.col("package_id").alias("path"), S.decode_text("content").alias("meta_text"))


def check_projection(members: DataFrame) -> DataFrame:
    """Is the layer in EPSG:4326?  From the .prj text, or the crs of GeoJSON, which is 4326 if absent."""
    text = S.decode_text("content")
    prj = F.col("member").endswith(".prj")
    geojson = F.col("member").endswith(".geojson") & ~F.col("member").contains("MACOS")
    crs = F.get_json_object(text, "$.crs.properties.name")
    wgs84 = (text.rlike("(?i)WGS[_ ]?(19)?84") & text.rlike("(?i)GEOGC[SR]") & ~text.rlike("(?i)PROJ(CS|CRS)"))
    known = crs.isNull() | crs.rlike("(?i)CRS84|EPSG:+4326")
    verdict = F.when(prj, wgs84).when(geojson, known)
    return members.filter(prj | geojson).groupBy("package_id").agg(F.bool_and(verdict).alias("projection_ok"))

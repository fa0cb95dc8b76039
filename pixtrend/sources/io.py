"""Raster tables on storage: scans with nodata handling and clustered sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixtrend.constants import BANDS
from pixtrend.functions.pixel import mask_nodata


def read_scenes(spark: SparkSession, path: str, pattern: str = "*.parquet",
                recursive: bool = True, nodata: int | None = 0, bands=BANDS,
                path_keys: dict[str, str] | None = None) -> DataFrame:
    """Scan every file under ``path`` matching ``pattern`` (recursively or one
    directory), add the file as ``source_file`` and turn nodata into NULL.

    A recursive scan does not discover partition folders; the columns that
    ``write_mosaic`` puts there (``path_keys``: name -> type, ``year`` by
    default) are read from the file's path where the files lack them.

    Band columns missing from the files are simply absent; filters and column
    selections on the result are pushed into the parquet reader.
    """
    r = spark.read.option("pathGlobFilter", pattern)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    df = r.parquet(path).withColumn("source_file", F.col("_metadata.file_path"))
    for name, kind in (path_keys or {"year": "int"}).items():
        if name not in df.columns:
            part = F.regexp_extract("source_file", f"/{name}=([^/]+)/", 1)
            df = df.withColumn(name, F.when(part != "", part).cast(kind))
    if nodata is not None:
        df = df.withColumns({b: mask_nodata(b, nodata) for b in bands if b in df.columns})
    return df


def read_mosaic(spark: SparkSession, path: str) -> DataFrame:
    """Read a table written by ``write_mosaic`` (``year`` from the folders)."""
    return spark.read.parquet(path)


def write_mosaic(df: DataFrame, path: str, partition_by=("year",), cluster=("tile_y", "tile_x"),
                 sort=("y", "x"), mode: str = "overwrite", partitions: int | None = None,
                 replace_partitions: bool = False) -> None:
    """Write a pixel table partitioned by year and clustered by tile.

    Rows of a tile land in the same files, sorted by ``(y, x)``: row-group
    min/max statistics then prune spatial range predicates (clip to an AOI),
    and readers that group by tile find their rows together.
    ``replace_partitions`` overwrites only the partition folders present in ``df``.
    """
    cl = [c for c in (*partition_by, *cluster) if c in df.columns]
    if partitions:
        df = df.repartition(partitions, *cl)
    elif cl:
        df = df.repartition(*cl)
    df = df.sortWithinPartitions(*cl, *[c for c in sort if c in df.columns])
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if replace_partitions:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)

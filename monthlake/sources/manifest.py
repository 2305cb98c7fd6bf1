"""File manifests of a layer and the incremental sync plan between two copies."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Layer name -> object prefix (the layout of the shared bucket).
LAYERS = {"bronze": "bronze/", "prata": "silver/", "ouro": "gold/", "raw": "raw/"}


def scan_manifest(spark: SparkSession, path: str, glob: str | None = None, time_col: str = "modified") -> DataFrame:
    """``(path, <time_col>, length)`` of every file under ``path``, recursively; paths are
    relative to it, as ``select_layers`` and ``diff_manifest`` take them.

    Only metadata is read: the ``content`` column is never selected, so files are not
    opened. Directory markers are skipped."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    # Scheme and authority are the file system's; the base path is a suffix of what is before it.
    base = "/" + path.split("://", 1)[-1].split(":", 1)[-1].strip("/") + "/"
    relative = F.substring_index(F.col("path"), base, -1)
    return r.load(path).where(~F.col("path").endswith("/")).select(
        relative.alias("path"), F.col("modificationTime").alias(time_col), "length")


def layer_of(path: Column, layers: Mapping[str, str] = LAYERS) -> Column:
    """Name of the layer whose prefix starts the relative object path (NULL if none)."""
    out = None
    for name, prefix in layers.items():
        hit = path.startswith(prefix)
        out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
    return out


def select_layers(manifest: DataFrame, layer: str, layers: Mapping[str, str] = LAYERS,
                  path_col: str = "path") -> DataFrame:
    """Objects of one layer (by prefix) or of every layer (``'all'``), tagged ``layer``."""
    if layer != "all" and layer not in layers:
        raise ValueError(f"unknown layer {layer!r}; use one of {sorted(layers)} or 'all'")
    chosen = dict(layers) if layer == "all" else {layer: layers[layer]}
    tagged = manifest.where(~F.col(path_col).endswith("/")).withColumn("layer", layer_of(F.col(path_col), chosen))
    return tagged.where(F.col("layer").isNotNull())


def diff_manifest(remote: DataFrame, local: DataFrame, mode: str = "incremental",
                  path_col: str = "path", remote_time: str = "updated", local_time: str = "modified") -> DataFrame:
    """Sync plan: ``download`` when the object is missing locally or the remote copy is
    newer (``full`` mode: always), else ``skip``. Both times are UTC instants."""
    if mode not in ("incremental", "full"):
        raise ValueError(f"mode must be 'incremental' or 'full', got {mode!r}")
    loc = local.select(F.col(path_col).alias("__p"), F.col(local_time).alias("__lt"))
    j = remote.join(loc, remote[path_col] == loc["__p"], "left")
    if mode == "full":
        action = F.lit("download")
    else:
        action = F.when(F.col("__lt").isNull() | (F.col(remote_time) > F.col("__lt")), F.lit("download")) \
                  .otherwise(F.lit("skip"))
    return j.withColumn("action", action).drop("__p").withColumnRenamed("__lt", f"local_{local_time}")


def summarize(diff: DataFrame, by: str = "layer") -> DataFrame:
    """Downloaded / skipped counts per layer (one partial+final aggregate)."""
    return diff.groupBy(by).agg(
        F.count_if(F.col("action") == "download").alias("downloaded"),
        F.count_if(F.col("action") == "skip").alias("skipped"))

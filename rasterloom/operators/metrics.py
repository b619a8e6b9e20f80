"""Quality metrics of a transform; each image is measured where it lies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.functions import raster
from rasterloom.operators.images import measure_images


def edge_retention(pairs: DataFrame, key: str, low: int = 100, high: int = 200) -> DataFrame:
    """(key, source_edges, kept_edges, error, retention): edges in ``image`` and in ``result``, per image.

    Both images must have the same size. Retention is null if the source has no edges or ``error`` is set.
    """

    def step(image, result):
        before = raster.edges(image, low, high)
        kept = before & raster.edges(result, low, high)
        return [{"source_edges": int(before.sum()), "kept_edges": int(kept.sum())}]

    counts = measure_images(
        pairs, step, "source_edges long, kept_edges long", [key], ("image", "result")
    )
    share = F.try_divide(F.col("kept_edges"), F.col("source_edges"))
    return counts.withColumn("retention", share.cast("double"))


def texture_ratio(pairs: DataFrame, key: str) -> DataFrame:
    """(key, energy_before, energy_after, error, suppression) with 1 - after / before, null if before is 0."""

    def step(image, result):
        return [
            {
                "energy_before": raster.laplacian_energy(image),
                "energy_after": raster.laplacian_energy(result),
            }
        ]

    energy = measure_images(
        pairs, step, "energy_before long, energy_after long", [key], ("image", "result")
    )
    left = F.try_divide(F.col("energy_after"), F.col("energy_before"))
    return energy.withColumn("suppression", (F.lit(1.0) - left).cast("double"))


def param_sweep(images: DataFrame, grid: Sequence[tuple[int, int]]) -> DataFrame:
    """Edge density per (low, high) setting over all images, and ``failed``, the images not measured.

    The settings travel with the task, so each image is read once for all of them; only small partial sums are
    shuffled.
    """
    settings = sorted(set(grid))

    def step(image):
        gray = raster.luma(image, raster.EDGE_WEIGHTS, raster.EDGE_SHIFT)
        rows = []
        for low, high in settings:
            found = raster.link_edges(raster.edge_classes(gray, low, high))
            rows.append({"low": low, "high": high, "edges": int(found.sum()), "pixels": gray.size})
        return rows

    none = [{"low": low, "high": high, "edges": None, "pixels": None} for low, high in settings]
    counts = measure_images(images, step, "low int, high int, edges long, pixels long", [], failed=none)
    return (
        counts.groupBy("low", "high")
        .agg(
            F.count("edges").alias("images"),
            F.count("error").alias("failed"),
            F.sum("edges").alias("edges"),
            F.sum("pixels").alias("pixels"),
        )
        .withColumn("density", F.col("edges") / F.col("pixels"))
    )

"""The composed steps: rasters to pixel table, pixel table to model, model to district figures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from verdigrid.meta import GridMeta, require_same_crs
from verdigrid.operators.bands import PIXEL_KEY, STACK_BANDS, valid_pixels
from verdigrid.operators.grid import pixel_centres
from verdigrid.operators.regression import (
    FEATURES, SEEDS, TARGET, cooling_effect, counterfactual, score_table, train_all,
)
from verdigrid.operators.spatial import clip_points, district_services, mask_and_crop, mask_by_polygons
from verdigrid.operators.stack import stack_bands
from verdigrid.operators.warp import reproject_nearest
from verdigrid.session import materialise


def pixel_table(
    stack: DataFrame, meta: GridMeta, study_area: DataFrame, study_area_crs: str,
    polygon: Sequence[str] = ("district_id",), bands: Sequence[str] = STACK_BANDS,
) -> DataFrame:
    """Stack to model input: valid first band, pixel centres, clipped to the study area."""
    rows = pixel_centres(valid_pixels(stack, bands[0]), meta)
    clipped = clip_points(rows, study_area, polygon, meta.crs, study_area_crs)
    return clipped.select("row_id", "col_id", "x", "y", *bands)


def raster_processing(
    rasters: Sequence[tuple[DataFrame, GridMeta]], target: GridMeta, study_area: DataFrame,
    study_area_crs: str, polygon: Sequence[str] = ("district_id",), names: Sequence[str] = STACK_BANDS,
    masks: Sequence[tuple[DataFrame, str] | None] | None = None,
) -> tuple[DataFrame, GridMeta]:
    """Mask the rasters, reproject those that are not on the target grid yet, stack, and make the pixel table.

    ``masks`` gives for each raster the edges and CRS of the polygons it is masked by, or None. A raster that is moved is cropped to the
    window around its mask first. All steps stay lazy: nothing is written between them, and cells without a source row are not made,
    as the stack takes absent rows as missing.
    """
    aligned = []
    for (df, meta), mask in zip(rasters, masks or [None] * len(rasters), strict=True):
        bands = list(meta.bands)
        on_grid = meta.crs == target.crs and meta.same_grid(target)
        if mask is not None:
            edges, crs = mask
            centred = pixel_centres(df, meta)
            if on_grid:
                require_same_crs(meta.crs, crs)
                df = mask_by_polygons(centred, edges, bands, polygon)
            else:
                df, meta = mask_and_crop(centred, meta, edges, bands, polygon, crs)
            df = df.select(*PIXEL_KEY, *bands)
        if on_grid:
            aligned.append((df, meta))
            continue
        moved, grid = reproject_nearest(df, meta, target, bands, keep_outside=False)
        aligned.append((moved, grid.with_bands(bands)))
    stack, meta = stack_bands(aligned, names)
    return pixel_table(stack, meta, study_area, study_area_crs, polygon, names), meta


def data_science(
    model_input: DataFrame, seeds: Mapping[str, int] = SEEDS, active: str = "active",
    features: Sequence[str] = FEATURES, target: str = TARGET,
) -> tuple[DataFrame, DataFrame]:
    """Scores of all model configurations, and the counterfactual of the active one.

    The input is stored once: splitting, fitting and predicting read it several times.
    """
    stored = materialise(model_input, "model-input")
    trained = train_all(stored, seeds, features, target)
    model, _ = trained[active]
    return score_table(trained, target), counterfactual(stored, model, target=target)


def ecosystem_services(
    model_input: DataFrame, predictions: DataFrame, districts: DataFrame,
    polygon: Sequence[str] = ("district_id",), target: str = TARGET,
) -> DataFrame:
    """Cooling by trees per district from measured and counterfactual temperature."""
    measured = model_input.select("row_id", "col_id", target)
    return district_services(
        cooling_effect(predictions.join(measured, ["row_id", "col_id"]), target), districts, polygon
    )

"""Entry 3: the interactive slice view as DataFrame-returning panels, plus batch
what-if scoring over a table of scenarios."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.operators import cube, features, models, prep, summaries, zones
from zonecast.operators.features import FeatureState


class Panels(Mapping):
    """Panel frames by name; a frame is built when it is first asked for, so unused panels cost nothing."""

    def __init__(self, builders: dict):
        self._builders, self._built = builders, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def dashboard_panels(df: DataFrame, pitch_types: Sequence[str] | None, pitchers: Sequence[str] | None = None,
                     heatmap_pitch_type: str = "All", bins: int = 25, grid_value: str = "count",
                     grid_filters: dict | None = None, metrics: DataFrame | None = None,
                     importances: DataFrame | None = None, cells: DataFrame | None = None) -> Panels:
    """Every panel of the view for one filter state.  An empty or tiny slice gives empty or zero frames.

    ``metrics`` (stored metrics) and ``importances`` add the model panels.  With ``cells``
    (``cube.dashboard_cells(df)``, built once for all filter states) every panel but the heatmap and the
    histogram reads only them.
    """
    df = prep.derive_name(df)
    cond = prep.multiselect_condition(df, pitch_types, pitchers)
    shown = df.filter(cond)
    heat = prep.filter_slice(shown, pitch_type=heatmap_pitch_type)
    grid_src = prep.filter_slice(df, **(grid_filters or {}))
    options = [c for c in ("pitch_type", "pitcher_name", "stand", "p_throws", "balls", "strikes") if c in df.columns]
    panels = {
        "filter_options": lambda: summaries.filter_options_all(df, options),
        "shown_vs_total": lambda: prep.shown_vs_total(df, cond),
        "overview": lambda: summaries.overview_totals(shown),
        "rate_by_pitch_type": lambda: summaries.rate_by(shown, "pitch_type"),
        "rate_by_count": lambda: summaries.rate_by_count_label(shown),
        "speed_histogram": lambda: zones.speed_histogram(shown),
        "heatmap": lambda: zones.zone_heatmap(prep.min_rows_gate(heat, 10), bins),
        "heatmap_summary": lambda: summaries.slice_summary(heat),
        "zone_grid": lambda: zones.zone_grid_scaled(prep.min_rows_gate(grid_src, 5), grid_value),
        "grid_summary": lambda: summaries.overview_totals(grid_src),
    }
    if cells is not None:
        shown_cells = cells.filter(prep.multiselect_condition(cells, pitch_types, pitchers))
        heat_cells = prep.filter_slice(shown_cells, pitch_type=heatmap_pitch_type)
        grid_cells = prep.filter_slice(cells, **(grid_filters or {}))
        panels |= {
            "filter_options": lambda: cube.filter_options(cells, options),
            "shown_vs_total": lambda: cube.shown_vs_total(cells, prep.multiselect_condition(cells, pitch_types, pitchers)),
            "overview": lambda: cube.totals(shown_cells),
            "rate_by_pitch_type": lambda: cube.rate_by(shown_cells, "pitch_type"),
            "rate_by_count": lambda: cube.rate_by_count_label(shown_cells),
            "heatmap_summary": lambda: cube.slice_summary(heat_cells),
            "zone_grid": lambda: cube.zone_grid_scaled(grid_cells, grid_value, 5),
            "grid_summary": lambda: cube.totals(grid_cells),
        }
    if metrics is not None:
        panels["metrics"] = lambda: metrics
    if importances is not None:
        panels["top_importances"] = lambda: models.top_importances(importances)
    return Panels(panels)


def what_if(model: PipelineModel, state: FeatureState, scenarios: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Score a table of scenarios with the serving feature rule; adds call and band."""
    fm = features.featurize_with_state(scenarios, state, keep=keys)
    fm = fm.withColumn("is_strike", F.lit(0))  # placeholder label for the scorer's schema
    scored = models.score(model, fm, state, "what_if", keys).drop("label", "model")
    return models.score_bands(scored)

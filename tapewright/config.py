"""All tunable parameters in one immutable object; every job takes it as an argument."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Settings:
    # Result-defining defaults.
    window_seconds: int = 60
    watermark_seconds: int = 120
    trigger_seconds: int = 5
    repeat_seconds: int = 3_600
    spread_threshold_pct: float = 1.0
    large_trade_value: float = 100_000.0
    high_trade_count: int = 500
    value_upper_bound: float = 1e9
    z_window: int = 100
    z_min_rows: int = 20
    z_threshold: float = 3.0
    feature_window: int = 25
    contamination: float = 0.02
    forest_seed: int = 42
    forest_min_rows: int = 20
    #: 0: exact thresholds; else the rank error that a sketch of the scores may have.
    threshold_rank_error: float = 0.0
    forest_trees: int = 100
    forest_tree_rows: int = 256
    history_rows: int = 50
    top_rows: int = 10
    payload_series_points: int = 600
    chart_series_points: int = 2000
    histogram_bins: int = 50

    # Scale knobs: they decide how work is divided, never what the result is.
    rows_per_slice: int = 4_000_000
    slice_sample_rows: int = 50
    quantile_rows: int = 2_000_000
    lookup_rows: int = 200_000
    salt_rows: int = 2_000_000
    forest_broadcast_bytes: int = 128 * 1024 * 1024
    forest_chunk_rows: int = 500_000

    def with_options(self, **changes) -> "Settings":
        return replace(self, **changes)


DEFAULTS = Settings()

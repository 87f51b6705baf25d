"""Settings of the composed runs. Defaults are fixed values of the source's configuration."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from demandspark.keys import SeriesKeys
from demandspark.operators.contracts import SheetContract
from demandspark.operators.impute import ImputeConfig
from demandspark.operators.trees import SEARCH_RANGES, VARIANTS
from demandspark.sources.grid import KEY_PATTERN


@dataclass(frozen=True)
class RunConfig:
    root: str
    sheets: str
    keys: SeriesKeys = SeriesKeys(ids=("unique_id",), time="timestamp", target="actual_demand_mw", step=900)
    series_id: str = "grid_1"
    key_pattern: str = KEY_PATTERN
    contract: SheetContract = SheetContract()
    impute: ImputeConfig = ImputeConfig()
    bad_times: tuple[datetime, ...] = (datetime(2024, 11, 21, 14, 45), datetime(2025, 3, 24, 16, 0))
    season: int = 96
    horizon: int = 96
    test_days: int = 14
    variants: tuple[str, ...] = VARIANTS
    trials: int = 40
    search_ranges: dict = field(default_factory=lambda: dict(SEARCH_RANGES))
    drift_rows: int = 96
    run: int | None = None  # step of this run's metrics, of which the latest decide; default: one more than the last

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

"""Business constants and run parameters.

Every operator takes these as arguments; the values here are the defaults
that reproduce the original retail pipeline. ``FIXTURE`` holds the values
used against the driver's TPC-H-shaped test tables.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must equal the original pipeline's for right results).
# Item-code alphabetic prefix -> standard department name, 43 entries.
# ---------------------------------------------------------------------------
PREFIX_TO_DEPARTMENT: dict[str, str] = {
    "ADD": "ADD ONS",
    "BAH": "BIGGS AT HOME",
    "BDS": "BDS",
    "BEEF": "SIZZLERS",
    "BEF": "SIZZLERS",
    "BEV": "BEVERAGES",
    "BLK": "BULK ORDER",
    "BRK": "BREAKFAST",
    "BL": "BIGGS LOYALTY",
    "BO": "BULK ORDER",
    "BS": "BURGERS AND SANDWICHES",
    "BULK": "BULK ORDER",
    "CHM": "CHICKEN MEALS",
    "CKS": "CAKES",
    "CLM": "CLASSIC MEALS",
    "DEL": "FOOD PANDA",
    "EVENT": "EVENT",
    "F": "FUNCTION",
    "FND": "BURGERS AND SANDWICHES",
    "FP": "FP COFFEE",
    "GB": "GO BIGG",
    "KEF": "KIDS EAT FREE",
    "MI": "BIGGS MERCH ITEMS",
    "MOM": "MOM KNOWS BEST",
    "MP": "MARKETING PROMOS",
    "NES": "NESPRESSO",
    "PARTY": "PARTY PACKS",
    "PI": "PREMIUM ITEMS",
    "PP": "PARTY PACKS",
    "PREM": "PREMIUM ITEMS",
    "PST": "PASTA DISHES",
    "REP": "REPRESENTATION",
    "RND": "RND",
    "RSD": "RSD PROMOS",
    "SAL": "SALAD DRESSINGS",
    "SHK": "SHAKES",
    "SID": "TOPSIDERS",
    "SIZ": "SIZZLERS",
    "SLD": "SALAD DELIGHTS",
    "SUP": "SOUP",
    "TEST": "TEST MARKET",
    "UP": "UPGRADES",
    "XTR": "EXTRAS",
}

# Branch the override rules apply to, and the rule outputs.
OVERRIDE_BRANCH = "BRLN"
IGNORE_FLAG = "ignore"
ACTIVE_STATUS = "active"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class OverrideRule:
    """Set ``dept_name_std`` to ``value`` where every given condition holds.

    Rules are applied in list order and the last matching rule wins.
    """

    value: str
    branch: str | None = None
    dep_codes: tuple[int, ...] | None = None
    incode: str | None = None


def default_override_rules(branch: str = OVERRIDE_BRANCH) -> list[OverrideRule]:
    # The three business overrides, in the original order.
    return [
        OverrideRule("NANAYS FAVORITE", branch=branch, dep_codes=(53, 54)),
        OverrideRule("BIGGS LOYALTY", branch=branch, dep_codes=(42,)),
        OverrideRule("PASTA DISHES", branch=branch, incode="SID12"),
    ]


@dataclass(frozen=True)
class RunParams:
    """Parameters of one pipeline run (defaults = original pipeline)."""

    override_rules: tuple[OverrideRule, ...] = field(
        default_factory=lambda: tuple(default_override_rules())
    )
    start_year: int = 2023
    end_year: int = 2024
    top_n: int = 10
    iqr_k: float = 1.5
    z_k: float = 1.5
    arima_order: tuple[int, int, int] = (1, 1, 1)
    train_end: dt.date = dt.date(2024, 3, 31)
    mape_threshold: float = 1.0
    lags: tuple[int, ...] = (1, 7)
    test_fraction: float = 0.2
    seed: int = 42
    n_trees: int = 100
    null_safe: bool = True


# Values used with the driver's test tables (FIXTURES.md section 2).
FIXTURE = RunParams(
    override_rules=tuple(default_override_rules("B1")),
    start_year=1998,
    end_year=1999,
    train_end=dt.date(2000, 3, 31),
)

# Column names of the series every forecasting step works on.
SERIES_KEYS = ("branch", "ite_desc_std")
DATE_COL = "date"


@dataclass(frozen=True)
class ForecastConfig:
    """T5: one forecasting run (order, train end, column names, modes)."""

    order: tuple[int, int, int] = (1, 1, 1)
    train_end: dt.date = dt.date(2024, 3, 31)
    date_col: str = DATE_COL
    branch_col: str = "branch"
    item_col: str = "ite_desc_std"
    quant_col: str = "quantity_cap"
    start_mode: str = "train_end"
    eval_mode: str = "reference"

    @property
    def keys(self) -> tuple[str, str]:
        return (self.branch_col, self.item_col)

"""Fixed values and run parameters."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

# --- fixed values: results depend on them ---------------------------------
FX_TO_VND = {1: "26202.0", 4: "27.0"}  # currency code -> rate; others count as 1
SPIKE_FACTOR = 3  # a line price above this multiple of the previous month is a spike
PRICE_CAP = 50000  # cap on unit prices of ordinary products
UNCAPPED_CODE_PREFIX = "3D"
PRICE_TIER_PROBS = (0.33, 0.67)
COST_SUSPECT, COST_HIGH = 5.0, 1.5  # allocated cost / revenue
SAMPLE_QTY, SAMPLE_REVENUE = 500, 2000000
NEAR_LIMIT = 0.8
DEFAULT_MARK, DEFAULT_ID_MARK = "2020-01-01 00:00:00", "0"
NULL_MARK_STANDIN = "2000-01-01"
DATE_DIM_START, DATE_DIM_END = date(2020, 1, 1), date(2030, 12, 31)
SNAPSHOT_START = date(2023, 1, 1)
TARGET_BAND = (20, 35)
TRANSFER_CODE = "17"
ZINC_ITEM_ID = 8530
ZINC_ITEM_CODE = "VTSX-KEMIN-2"
ZINC_ITEM_NAME = "VTSX_Kem In_Offset Kodak Elecxd QC 80x103 cm"
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class RunParams:
    """Everything a run would otherwise take from the wall clock or from constants."""

    as_of: date
    snapshot_start: date = SNAPSHOT_START
    date_start: date = DATE_DIM_START
    date_end: date = DATE_DIM_END
    fx: dict = field(default_factory=lambda: dict(FX_TO_VND))
    zinc_item_id: int = ZINC_ITEM_ID

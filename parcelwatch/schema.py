"""Column names and the fixed output columns of a processed shipment table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Column names of the input and output tables.
TRACKING_NUMBER = "Tracking Number"
CARRIER_CODE = "Carrier Code"
PROMISED_DATE = "Promised Delivery Date"
DELIVERY_STATUS = "Delivery Tracking Status"
STATUS_FIELDS = ("code", "derivedCode", "statusByLocale", "description")
FLAGS = (
    "IsPreTransit",
    "IsDelivered",
    "HasException",
    "IsRTS",
    "IsStalled",
    "Damaged",
    "UnableToDeliver",
)
LABEL = "CalculatedStatus"
REASONS = "CalculatedReasons"
LATEST_DETAIL = "latestStatusDetail"
ANCILLARY = "LatestAncillaryText"
LATEST_TS = "LatestEventTimestampUtc"
SCAN_COUNT = "ScanEventsCount"
SCAN_TIMES = "ScanEventTimestamps"
IDLE_DAYS = "DaysSinceLatestEvent"

CONTRACT_SUFFIX = (*STATUS_FIELDS, *FLAGS, LABEL, REASONS)


def col(name: str) -> Column:
    """Column by its literal name: blanks, dots and backticks are part of the name."""
    return F.col("`" + name.replace("`", "``") + "`")


def has(df: DataFrame, *names: str) -> bool:
    """True when every name is a column of ``df``, compared exactly."""
    present = set(df.columns)
    return all(n in present for n in names)

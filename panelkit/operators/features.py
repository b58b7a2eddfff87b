"""Time-series features inside a key: lag and rolling sums.

All windows share ``partitionBy(key).orderBy(time)`` so Spark plans a single
exchange for all of them.  They run on the aggregated panel, never on raw
rows, so one hot key costs ``years`` rows, not a third of the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from panelkit.schemas import RECENT_FOLLOWING, RECENT_PRECEDING


def lag_feature(df: DataFrame, *, key: str = "State", time: str = "Year",
                value: str = "Avg_kWh", out: str = "PrevPrice", offset: int = 1,
                drop_missing: bool = True) -> DataFrame:
    """Previous row's value within the key.

    Runs over the rows present, so a missing year is skipped, not nulled.
    """
    w = Window.partitionBy(key).orderBy(time)
    df = df.withColumn(out, F.lag(value, offset).over(w))
    return df.dropna(how="any", subset=[out]) if drop_missing else df


def rolling_sum(df: DataFrame, *, key: str = "State", time: str = "Year",
                value: str = "DC_Opened", out: str = "RecentOpenings",
                preceding: int = RECENT_PRECEDING,
                following: int = RECENT_FOLLOWING) -> DataFrame:
    """Sum over ROWS BETWEEN ``preceding`` PRECEDING AND ``following`` FOLLOWING.

    The default (3, 1) includes the next row, as the original does.
    """
    w = Window.partitionBy(key).orderBy(time).rowsBetween(-preceding, following)
    return df.withColumn(out, F.sum(value).over(w))


def recent_activity_filter(df: DataFrame, *, column: str = "RecentOpenings",
                           drop: bool = True) -> DataFrame:
    """keep rows with activity in the frame."""
    df = df.filter(F.col(column) > 0)
    return df.drop(column) if drop else df

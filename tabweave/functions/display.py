"""Text forms of values, for the last step of a report only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
NOT_AVAILABLE = "N/D"
NO_DELTA = "-"
ARROWS = {"up": "▲", "down": "▼", "flat": "→"}


def number_text(value: Column, digits: int = 4) -> Column:
    """Fixed decimals, or the mark for values that are not there."""
    number = value.cast("double")
    text = F.when(F.isnan(number), "nan").otherwise(F.format_string(f"%.{digits}f", number))
    return F.when(value.isNull(), F.lit(NOT_AVAILABLE)).otherwise(text)


def time_text(timestamp: Column) -> Column:
    """An ISO time cut to seconds, with a space between date and time."""
    return F.coalesce(F.replace(F.substring(timestamp, 1, 19), F.lit("T"), F.lit(" ")), F.lit(NOT_AVAILABLE))


def direction(delta: Column) -> Column:
    """up, down or flat; a change that is no number is flat, as it points nowhere."""
    return F.when(F.isnan(delta), "flat").when(delta > 0, "up").when(delta < 0, "down").when(delta == 0, "flat")


def delta_text(delta: Column, digits: int = 4) -> Column:
    """Arrow and signed difference, or a dash where there is nothing to compare."""
    way = direction(delta)
    arrow = F.when(way == "up", ARROWS["up"]).when(way == "down", ARROWS["down"]).otherwise(ARROWS["flat"])
    number = F.when(F.isnan(delta), "+nan").otherwise(F.format_string(f"%+.{digits}f", delta))
    text = F.concat(arrow, F.lit(" "), number)
    return F.when(delta.isNull(), F.lit(NO_DELTA)).otherwise(text)

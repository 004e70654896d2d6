from tidemart.functions.money import exact, signed_amount, signed_total
from tidemart.functions.naming import named, refuse, unused
from tidemart.functions.temporal import day_of, hour_end, hour_start, iso_day, previous_day, slice_path

__all__ = [
    "day_of",
    "exact",
    "hour_end",
    "hour_start",
    "iso_day",
    "named",
    "previous_day",
    "refuse",
    "signed_amount",
    "signed_total",
    "slice_path",
    "unused",
]

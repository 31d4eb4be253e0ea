"""Account ratios, their bins, and account age."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newslens import constants as C


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def follower_ratio(followers: Column | str, friends: Column | str) -> Column:
    """followers / (1 + friends) as a double; null where friends is -1."""
    return F.try_divide(_col(followers).cast("double"), (1 + _col(friends)).cast("double"))


def activity(statuses: Column | str, divisor: Column | str) -> Column:
    """statuses / (1 + divisor) as a double."""
    return F.try_divide(_col(statuses).cast("double"), (1 + _col(divisor)).cast("double"))


def ratio_bin(ratio: Column | str) -> Column:
    """Ten bins of 0.5 and one for all above; null goes to bin 0."""
    return _clamp(_col(ratio) * 2)


def activity_bin(value: Column | str) -> Column:
    """Ten bins of 1 and one for all above; null goes to bin 0."""
    return _clamp(_col(value))


def _clamp(value: Column) -> Column:
    # Clamped before the cast, so a huge ratio cannot overflow the integer.
    top = F.lit(float(C.USER_BINS - 1))
    kept = F.greatest(F.lit(0.0), F.least(top, F.coalesce(value, F.lit(0.0))))
    return kept.cast("int")


def account_age(created_at: Column | str, as_of: Column) -> Column:
    """Whole 24-hour days to `as_of` from a time such as `Wed Oct 10 20:19:24 +0000 2018`."""
    created = F.try_to_timestamp(F.substring(_col(created_at), 5, 64), F.lit(C.CREATED_AT_FORMAT))
    seconds = F.unix_timestamp(as_of) - F.unix_timestamp(created)
    return F.floor(seconds / 86400)


def lenient_int(value: Column | str) -> Column:
    """Integer part of a number held as text or as a number; null where it is neither."""
    return _col(value).try_cast("double").try_cast("int")

"""Right-closed time buckets.

Bucket ``b`` of width ``d`` seconds covers ``((b-1)*d, b*d]`` and is labelled
by its right edge.  ``window()`` is closed on the left, so it does not fit.
"""

from __future__ import annotations


def bucket_of(seconds: str, bucket_duration: int) -> str:
    """BIGINT index of the bucket holding an epoch time in seconds."""
    return f"ceil({seconds} / {check_duration(bucket_duration)})"


def bucket_end(bucket: str, bucket_duration: int) -> str:
    """Right edge of a bucket as TIMESTAMP (the event-time column of streams)."""
    return f"timestamp_seconds({bucket} * {check_duration(bucket_duration)})"


def bucket_time(bucket: str, bucket_duration: int) -> str:
    """Right edge of a bucket as RFC 3339 text in UTC."""
    return rfc3339(f"{bucket} * {check_duration(bucket_duration)}")


def rfc3339(epoch_seconds: str) -> str:
    """RFC 3339 UTC text of whole epoch seconds, whatever the session time zone."""
    # Adding an interval to a zone-less timestamp never consults the session zone.
    moment = f"TIMESTAMP_NTZ '1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {epoch_seconds})"
    return f"concat(translate(string({moment}), ' ', 'T'), '+00:00')"


def check_duration(bucket_duration: int) -> int:
    if isinstance(bucket_duration, bool) or int(bucket_duration) != bucket_duration or bucket_duration < 1:
        raise ValueError(f"bucket duration must be a whole number of seconds, at least 1: {bucket_duration!r}")
    return int(bucket_duration)

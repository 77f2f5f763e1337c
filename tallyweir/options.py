"""Parameters that change results."""

from __future__ import annotations

import math
from dataclasses import dataclass

from tallyweir.functions.buckets import check_duration
from tallyweir.operators.contacts import WEIGHTINGS


class OptionMismatch(ValueError):
    """Open buckets exist that were built with other options."""


class StateMismatch(ValueError):
    """A state folder and a checkpoint do not belong together."""


@dataclass(frozen=True)
class RunOptions:
    """Options of incremental and streaming runs.

    bucket_duration  width of a bucket in seconds
    lookback_factor  number of buckets to wait before a bucket is closed
    skip_to_end      the first run that meets a source only notes where it ends and publishes nothing of it
    max_lines        lines read per source and run, 0 for all; the next run goes on after them
    weighting        how contacts of a server met twice in a request count
    outbox_limit     number of failed sends kept for later, the oldest fall off; None keeps all
    max_ahead        seconds that a line may be ahead of the clock; one further ahead is rejected as ``future``
                     and does not move the mark of its source; None accepts any time
    keep_rejects     keep rejected lines with their reasons, a table per run
    """

    bucket_duration: int = 60
    lookback_factor: int = 2
    skip_to_end: bool = True
    max_lines: int = 0
    weighting: str = "per_request"
    outbox_limit: int | None = None
    max_ahead: int | None = 86_400
    keep_rejects: bool = False

    def __post_init__(self) -> None:
        check_duration(self.bucket_duration)
        if self.lookback_factor < 0:
            raise ValueError(f"lookback factor must not be negative: {self.lookback_factor}")
        if self.max_lines < 0 or (self.outbox_limit or 0) < 0 or (self.max_ahead or 0) < 0:
            raise ValueError("max_lines, outbox_limit and max_ahead must not be negative")
        if self.weighting not in WEIGHTINGS:
            raise ValueError(f"weighting must be one of {WEIGHTINGS}: {self.weighting!r}")

    def check_against(self, bucket_duration: int, lookback_factor: int, weighting: str) -> None:
        """Refuse to go on with open buckets of another width, closing rule or weighting."""
        before = {"bucket duration": bucket_duration, "lookback factor": lookback_factor, "weighting": weighting}
        now = (self.bucket_duration, self.lookback_factor, self.weighting)
        wrong = [f"{name} {old}, now {new}" for (name, old), new in zip(before.items(), now) if old != new]
        if wrong:
            raise OptionMismatch(f"open buckets were built with other options: {'; '.join(wrong)}")

    def last_bucket(self, now: float) -> int | None:
        """The last bucket that a line may lie in at the time ``now``."""
        return None if self.max_ahead is None else math.ceil((now + self.max_ahead) / self.bucket_duration)

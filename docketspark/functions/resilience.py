"""Retry policies, backoff schedules and circuit breakers."""

from __future__ import annotations

import functools
import random
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLOSED, OPEN, HALF_OPEN = "closed", "open", "half_open"


class RetryExhausted(Exception):
    """All attempts failed; `attempts` and `last` say how."""

    def __init__(self, attempts: int, last: Exception):
        super().__init__(f"gave up after {attempts} attempts: {last}")
        self.attempts, self.last = attempts, last


class CircuitOpenError(Exception):
    """A call that an open breaker did not let through; `retry_after` seconds are left."""

    def __init__(self, name: str, retry_after: float):
        super().__init__(f"circuit {name} is open for another {retry_after:.1f} s")
        self.retry_after = retry_after


@dataclass(frozen=True)
class RetryPolicy:
    max_attempts: int = 3
    base_delay: float = 1.0
    multiplier: float = 2.0
    max_delay: float = 60.0
    jitter: float = 0.5
    retryable: tuple[type[BaseException], ...] = (Exception,)

    def __post_init__(self):
        if self.max_attempts < 1:
            raise ValueError("max_attempts must be at least 1")
        if self.base_delay < 0 or self.jitter < 0:
            raise ValueError("delays cannot be negative")
        if self.max_delay < self.base_delay:
            raise ValueError("max_delay cannot be below base_delay")
        if self.multiplier < 1:
            raise ValueError("multiplier must be at least 1")

    def delay(self, attempt: int, rng: Callable[[], float] = random.random) -> float:
        """Seconds before retry number `attempt`; none before the first call."""
        if attempt <= 0:
            return 0.0
        return min(self.base_delay * self.multiplier ** (attempt - 1), self.max_delay) + rng() * self.jitter

    def is_retryable(self, error: BaseException) -> bool:
        return isinstance(error, self.retryable)


CONSERVATIVE = RetryPolicy(3, 5.0, 3.0, 120.0)
AGGRESSIVE = RetryPolicy(5, 0.5, 2.0, 10.0)


@dataclass
class Breaker:
    """Closed until `threshold` failures in a row; open for `recovery` seconds; then half open until a call's outcome."""

    threshold: int = 5
    recovery: float = 60.0
    name: str = "default"
    clock: Callable[[], float] = time.monotonic
    expected: tuple[type[BaseException], ...] = (Exception,)
    _state: str = field(default=CLOSED, init=False)
    failures: int = field(default=0, init=False)
    opened: float = field(default=0.0, init=False)

    @property
    def state(self) -> str:
        if self._state == OPEN and self.clock() - self.opened >= self.recovery:
            self._state = HALF_OPEN
        return self._state

    def succeeded(self) -> None:
        self._state, self.failures = CLOSED, 0

    def failed(self) -> None:
        self.failures += 1
        if self._state == HALF_OPEN or self.failures >= self.threshold:
            self.trip()

    def trip(self) -> None:
        self._state, self.opened = OPEN, self.clock()

    reset = succeeded

    def call(self, f: Callable, *args, **kwargs):
        if self.state == OPEN:
            raise CircuitOpenError(self.name, self.recovery - (self.clock() - self.opened))
        try:
            out = f(*args, **kwargs)
        except self.expected:
            self.failed()
            raise
        self.succeeded()
        return out


def with_retry(policy: RetryPolicy = RetryPolicy(), breaker: Breaker | None = None, sleep: Callable = time.sleep, raises: bool = True):  # noqa: B008
    """Decorates a function with retries, behind a breaker if one is given; an open breaker is not retried."""

    def decorate(f: Callable):
        @functools.wraps(f)
        def run(*args, **kwargs):
            for attempt in range(policy.max_attempts):
                if attempt:
                    sleep(policy.delay(attempt))
                try:
                    return breaker.call(f, *args, **kwargs) if breaker else f(*args, **kwargs)
                except CircuitOpenError:
                    raise
                except Exception as error:
                    if not policy.is_retryable(error):
                        raise
                    last = error
            if raises:
                raise RetryExhausted(policy.max_attempts, last) from last
            return None

        return run

    return decorate


def schedule(spark: SparkSession, attempts: int, policy: RetryPolicy = RetryPolicy()) -> DataFrame:  # noqa: B008
    """attempt, delay: the schedule without jitter."""
    k = F.col("attempt")
    grown = F.least(F.lit(float(policy.base_delay)) * F.pow(F.lit(float(policy.multiplier)), k - 1), F.lit(float(policy.max_delay)))
    return spark.range(0, attempts + 1).select(F.col("id").alias("attempt")).select("attempt", F.when(k > 0, grown).otherwise(0.0).alias("delay"))

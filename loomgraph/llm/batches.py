"""What the operators that run Python over whole texts share: the Arrow batch size and bounded memos."""

from __future__ import annotations

import functools
import gc

import pyarrow as pa
from pyspark.sql import SparkSession

#: Rows and bytes that an Arrow batch of whole texts holds at most.
TEXT_ROWS, TEXT_BYTES = 1024, 4 << 20


def small_batches(spark: SparkSession, rows: int = TEXT_ROWS, most: int = TEXT_BYTES) -> None:
    """Lowers the session's Arrow batch size to ``rows`` and ``most`` bytes where it is larger; it is never raised. The
    limits are read when a plan runs, so they stay with the session."""
    bytes_of = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, limit, parsed in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows, int), ("spark.sql.execution.arrow.maxBytesPerBatch", most, bytes_of)):
        now = parsed(spark.conf.get(key))
        if now <= 0 or now > limit:
            spark.conf.set(key, str(limit))


class Memo(dict):
    """Results of ``make`` by word, in two generations of ``most`` words: the older one is dropped, so that memory is
    bounded and frequent words stay. Words over 64 characters are not kept. See :func:`held` for how long one lives."""

    def __init__(self, make, most: int = 250_000):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, word):
        value = self.old.get(word)
        if value is None:
            value = self.make(word)
        if len(word) <= 64:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[word] = value
        return value


_now: dict = {}


def held(make):
    """Like ``lru_cache(maxsize=1)``, but with one result for all functions so decorated: a Python worker runs one operator
    after the other, and keeps the vocabulary and memo of the last one only."""

    @functools.wraps(make)
    def of(*args):
        key = make, args
        if key not in _now:
            if _now:
                _now.clear()
                gc.collect()  # memos and what fills them refer to each other
                pa.default_memory_pool().release_unused()
            _now[key] = make(*args)
        return _now[key]

    return of

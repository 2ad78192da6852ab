"""Time normalisation: every time column becomes epoch micros (Long).

Candle ``open_time`` may arrive as Long epoch milliseconds (stream records),
TIMESTAMP, or TIMESTAMP_NTZ (parquet written without a zone). All three map to
the same Long without depending on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def epoch_micros(df: DataFrame, name: str) -> Column:
    """Epoch microseconds of column ``name`` whatever its type."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.TimestampNTZType):
        # Zone-free: difference between two wall-clock values.
        return F.expr(
            f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{name}`)")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        return c.cast("long") * F.lit(1000)          # epoch milliseconds
    if isinstance(dtype, T.DateType):
        return F.datediff(c, F.lit("1970-01-01").cast("date")).cast("long") * F.lit(86_400_000_000)
    raise TypeError(f"{name}: unsupported time type {dtype}")


def floor_to(us: Column, step_us: int) -> Column:
    """Floor epoch micros to a multiple of ``step_us`` (exact Long arithmetic)."""
    return us - F.pmod(us, F.lit(step_us))


def bucket_ms(us: Column, step_ms: int) -> Column:
    """Bucket start in epoch milliseconds for a bucket width of ``step_ms``."""
    # an exact multiple of 1000, so the division is exact
    return (floor_to(us, step_ms * 1000) / F.lit(1000)).cast("long")


EPOCH_NTZ = "1970-01-01 00:00:00"


def ntz_from_millis(ms: Column) -> Column:
    """UTC wall-clock TIMESTAMP_NTZ for epoch milliseconds (no session zone)."""
    return F.timestamp_add("MILLISECOND", ms, F.lit(EPOCH_NTZ).cast("timestamp_ntz"))


def millis_to_utc_text(ms: Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Epoch milliseconds formatted in UTC (zone pinned, D14)."""
    return F.date_format(ntz_from_millis(ms), fmt)


ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"

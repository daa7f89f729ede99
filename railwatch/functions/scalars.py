"""Column expressions shared by the operators.  All stay on the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from railwatch.schemas import SCORED_GUARDRAILS

# Fixed value: an ISO-8601 instant needs date, "T", seconds and a zone.
ISO_INSTANT = r"^[+-]?\d{4,10}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|z|[+-]\d{2}(:?\d{2})?)$"


def non_blank(c: Column) -> Column:
    """True when the text holds at least one visible character (null gives false)."""
    return F.coalesce(c.rlike(r"\S"), F.lit(False))


def is_scored(name: Column) -> Column:
    """Guardrails whose findings carry a model confidence (null name gives false)."""
    return F.coalesce(name.isin(*SCORED_GUARDRAILS), F.lit(False))


def detector_ok(status: Column) -> Column:
    return status.isNull() | (F.upper(status) == "OK")


def instant_millis(text: Column) -> Column:
    """Epoch milliseconds of an ISO instant, null when the text is not one."""
    return F.when(text.rlike(ISO_INSTANT), F.unix_millis(F.try_to_timestamp(text)))


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 when the denominator is not positive."""
    return F.when(b > 0, a.cast("double") / b.cast("double")).otherwise(F.lit(0.0))


def clamp_floor_zero(c: Column) -> Column:
    return F.greatest(F.lit(0).cast("long"), c)


def window_name(size_ms: Column) -> Column:
    """``1m``, ``5m``, ... for whole minutes, seconds otherwise."""
    minutes = F.floor(size_ms / F.lit(60_000))
    whole = (minutes > 0) & (size_ms % 60_000 == 0)
    seconds = F.floor(size_ms / F.lit(1_000))
    return F.when(whole, F.concat(minutes.cast("string"), F.lit("m"))).otherwise(
        F.concat(seconds.cast("string"), F.lit("s"))
    )


def window_start(t: Column, size_ms: Column | int) -> Column:
    """Epoch-aligned start of the tumbling window that holds ``t``."""
    size = size_ms if isinstance(size_ms, Column) else F.lit(size_ms).cast("long")
    return t - F.pmod(t, size)


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)


def valid_vector(v: Column) -> Column:
    """Not null, not empty, every component finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return F.coalesce((F.size(v) > 0) & F.forall(v, finite), F.lit(False))


def cosine(a: Column, b: Column) -> Column:
    """Dot product of two unit vectors; null for invalid vectors or unequal sizes."""
    ok = valid_vector(a) & valid_vector(b) & (F.size(a) == F.size(b))
    return F.when(ok, dot(a, b))


def unit(v: Column) -> Column:
    """The vector scaled to length one; null for a zero vector."""
    norm = F.sqrt(dot(v, v))
    # The norm enters as an array, so that it is computed once and not once per component.
    norms = F.array_repeat(norm, F.size(v))
    return F.when(norm > 0, F.zip_with(v, norms, lambda x, n: x.cast("double") / n))


def cosine_to_unit(v: Column, u: Column) -> Column:
    """Cosine of any vector with a unit vector; null for invalid vectors or unequal sizes."""
    ok = valid_vector(v) & valid_vector(u) & (F.size(v) == F.size(u))
    norm = F.sqrt(dot(v, v))
    return F.when(ok & (norm > 0), dot(v, u) / norm)

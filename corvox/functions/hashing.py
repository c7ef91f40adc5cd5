"""Reproducible draws: every uniform number is a hash of a seed and stable ids, whatever the partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_u(seed: str, *ids: Column | str) -> Column:
    """A uniform number in [0, 1) from the first 32 bits of md5(seed:id:...)."""
    key = F.concat_ws(":", F.lit(seed), *(F.col(i).cast("string") if isinstance(i, str) else i.cast("string") for i in ids))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def md5_mod(text: Column, n: int) -> Column:
    """The 128-bit md5 of a text modulo n, folded over its four 32-bit parts."""
    out = F.lit(0).cast("long")
    for k in range(4):
        part = F.conv(F.substring(F.md5(text), 8 * k + 1, 8), 16, 10).cast("long")
        out = (out * ((1 << 32) % n) + part) % n
    return out


def split_for(text: Column, test: float = 0.05, validation: float = 0.05) -> Column:
    """train, validation or test by md5 modulo 1000."""
    h = md5_mod(text, 1000) / F.lit(1000.0)
    return F.when(h < test, "test").when(h < test + validation, "validation").otherwise("train")


def pick(values: list, u: Column) -> Column:
    """One of the values, by a uniform number."""
    return F.element_at(F.array(*map(F.lit, values)), (F.floor(u * len(values)) + 1).cast("int"))


def weighted_pick(values: list[tuple[object, float]], u: Column) -> Column:
    """One of the (value, weight) pairs, by a uniform number along the cumulative weights."""
    total, run, out = sum(w for _, w in values), 0.0, None
    for value, w in values[:-1]:
        run += w
        test = u < F.lit(run / total)
        out = F.when(test, F.lit(value)) if out is None else out.when(test, F.lit(value))
    last = F.lit(values[-1][0])
    return last if out is None else out.otherwise(last)


def list_size(kind: str, u: Column, low: int, high: int, rate: float = 0.1) -> Column:
    """A list size in [low, high] by a named law: loguniform, uniform, exponential or geometric."""
    if kind == "loguniform":
        raw = F.exp(F.lit(float(low)).cast("double") * 0 + F.log(F.lit(float(low))) + u * (F.log(F.lit(high + 1.0)) - F.log(F.lit(float(low)))))
    elif kind == "uniform":
        raw = low + F.floor(u * (high - low + 1))
    elif kind == "exponential":
        raw = low - F.log(1 - u) / rate
    elif kind == "geometric":
        raw = low + F.floor(F.log(1 - u) / F.log(F.lit(1 - rate)))
    else:
        raise ValueError(f"unknown law {kind}")
    return F.least(F.lit(high), F.greatest(F.lit(low), F.floor(raw))).cast("int")


def decaying_count(u: Column, decay: float, low: int, high: int) -> Column:
    """low plus a geometric number of further ones, high at most."""
    return F.least(F.lit(high), low + F.floor(F.log(1 - u) / F.log(F.lit(decay)))).cast("int")


def truncated_geometric(p: float, least: int, most: int) -> list[tuple[int, float]]:
    """(k, chance) for k in [least, most], proportional to (1 - p)^(k - 1) p."""
    raw = [(k, (1 - p) ** (k - 1) * p) for k in range(least, most + 1)]
    total = sum(w for _, w in raw)
    return [(k, w / total) for k, w in raw]

"""Find a value's place in an ascending array."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def upper_place(value: Column, bounds: Column, size: int) -> Column:
    """How many of the `size` ascending `bounds` are not above `value`, by halving: a step per bit of `size`."""
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(size.bit_length()))]).cast("array<int>")
    return F.aggregate(
        steps,
        F.lit(0),
        lambda place, step: F.when(
            (place + step <= size) & (F.get(bounds, place + step - 1) <= value), place + step
        ).otherwise(place),
    )

"""Column functions that put numbers into named classes."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bounds (exclusive) and names of the price classes.
PRICE_CLASSES = [(10, "budget"), (50, "mid_range")]
TOP_PRICE_CLASS = "premium"


def class_below(amount: Column, classes: list[tuple[float, str]], top: str) -> Column:
    """Name of the first class whose bound lies above `amount`; `top` when none does, and for NULL."""
    (bound, name), *others = classes
    label = F.when(amount < bound, F.lit(name))
    for bound, name in others:
        label = label.when(amount < bound, F.lit(name))
    return label.otherwise(F.lit(top))


def categorize_amount(amount: Column, small_threshold: float = 100, large_threshold: float = 1000) -> Column:
    """`small`, `medium` or `large`; a bound belongs to the class above it, NULL is `large`."""
    return class_below(amount, [(small_threshold, "small"), (large_threshold, "medium")], "large")


def price_category(price: Column) -> Column:
    return class_below(price, PRICE_CLASSES, TOP_PRICE_CLASS)


def age_group(age: Column) -> Column:
    return F.when(age >= 18, F.lit("adult")).otherwise(F.lit("minor"))

"""Rows out of parallel arrays inside a JSON payload."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parallel_elements(driver: Column, values: dict[str, Column]) -> Column:
    """An array with one struct (pos, driver, values...) per element of the driver array.

    A value array that is shorter than the driver, or missing, gives NULL;
    surplus values are cut. (`arrays_zip` would pad to the longest array.)
    """
    return F.transform(
        driver,
        lambda element, pos: F.struct(
            pos.alias("pos"),
            element.alias("driver"),
            *[F.get(array, pos).alias(name) for name, array in values.items()],
        ),
    )


def explode_parallel(
    df: DataFrame, driver: Column, values: dict[str, Column], *, keep: Sequence[str], driver_name: str
) -> DataFrame:
    """Exactly size(driver) rows per input row: the kept columns, `pos`, the driver element and the values.

    The arrays are zipped before the explode, so an output row carries one
    element of each array and not the arrays themselves.
    """
    zipped = df.select(*keep, F.inline(parallel_elements(driver, values)))
    return zipped.withColumnRenamed("driver", driver_name)

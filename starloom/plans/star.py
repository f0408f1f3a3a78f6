"""The frames an analytic view reads."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from starloom.schemas import DIM_BRAND, DIM_CUSTOMER, DIM_DATE, DIM_PRODUCT, DIM_PROFILE, FACT
from starloom.sources import layers


class Star(NamedTuple):
    """Facts and dimensions; a dimension no view of interest reads may be missing."""

    fact: DataFrame
    product: DataFrame
    brand: DataFrame
    customer: DataFrame | None = None
    profile: DataFrame | None = None
    date: DataFrame | None = None


def read_star(spark: SparkSession, root: str) -> Star:
    tables = (FACT, DIM_PRODUCT, DIM_BRAND, DIM_CUSTOMER, DIM_PROFILE, DIM_DATE)
    return Star(*[layers.read_table(spark, root, t) for t in tables])

"""How a query and its SQL are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from greenledger.registry.inputs import Inputs
from greenledger.registry.sql import FINE_COLUMNS, with_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def rounded(df: DataFrame) -> DataFrame:
    """Doubles at fixed places, so that engines may add in any order."""

    def places(name: str):
        value = F.col(name)
        if name in FINE_COLUMNS:
            return F.round(value, 9) + F.lit(0.0)
        short = F.when(F.abs(value) < 1e6, F.round(value, 6)).otherwise(F.round(value, 3))
        return short + F.lit(0.0)

    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)]
    return df.withColumns({name: places(name) for name in doubles}) if doubles else df


def query(name: str, sql: str | None):
    """Register ``build(inputs) -> DataFrame`` under a name, with its SQL."""

    def add(build: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(build(Inputs(spark, sf_dir)))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_ctes(sql)
        return build

    return add

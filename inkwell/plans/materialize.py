"""Models as tables or as views."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_tables(models: dict[str, DataFrame], path: str) -> dict[str, DataFrame]:
    """Writes each model to a new folder below ``path`` and returns them read back, in the given order.

    Later steps then read columns from files instead of computing the model again, and a lost
    executor costs no more than the step it was running.
    """
    written = {}
    for name, model in models.items():
        model.write.mode("errorifexists").parquet(f"{path}/{name}")
        written[name] = model.sparkSession.read.schema(model.schema).parquet(f"{path}/{name}")
    return written


def create_views(models: dict[str, DataFrame]) -> None:
    """Makes the models known to spark.sql() under their names."""
    for name, model in models.items():
        model.createOrReplaceTempView(name)

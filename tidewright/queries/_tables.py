"""Loading tables and registering queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, sf_dir: str, *names: str):
    found = [spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names]
    return found[0] if len(found) == 1 else found


class Registry:
    """Collects a module's queries and their DuckDB twins."""

    def __init__(self):
        self.queries, self.oracles = {}, {}

    def query(self, sql: str | None = None):
        def keep(fn):
            self.queries[fn.__name__] = fn
            if sql:
                self.oracles[fn.__name__] = sql
            return fn

        return keep


__all__ = ["DataFrame", "Registry", "load"]

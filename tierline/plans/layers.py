"""Where one environment's tables live: everything is under one root path."""

from dataclasses import dataclass

from pyspark.sql import SparkSession

from tierline.schema import (
    BRONZE_PARTITIONS,
    GOLD,
    GOLD_PARTITIONS,
    SILVER,
    SILVER_ORDER,
    SILVER_PARTITIONS,
)
from tierline.sources.versioned import VersionedTable


@dataclass(frozen=True)
class Layers:
    """The landing directories and tables of one environment; another root is another one.

    `any_store` allows a root on a store whose renames are not known to be atomic.
    """

    spark: SparkSession
    root: str
    any_store: bool = False

    def landing(self, feed: str) -> str:
        return f"{self.root}/landing/{feed}"

    def bronze(self, feed: str) -> VersionedTable:
        """Raw rows of one feed; its first ingest fixes the types, later ones may add columns."""
        path = f"{self.root}/bronze/{feed}"
        return VersionedTable(self.spark, path, BRONZE_PARTITIONS, any_store=self.any_store)

    @property
    def silver(self) -> VersionedTable:
        path = f"{self.root}/silver/activity"
        return VersionedTable(
            self.spark, path, SILVER_PARTITIONS, SILVER, order=SILVER_ORDER, any_store=self.any_store
        )

    @property
    def gold(self) -> VersionedTable:
        path = f"{self.root}/gold/activity"
        return VersionedTable(self.spark, path, GOLD_PARTITIONS, GOLD, any_store=self.any_store)

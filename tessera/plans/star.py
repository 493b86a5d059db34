"""The star: one fact and five dimensions, as produced by the gold layer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Star:
    fact: DataFrame
    dim_date: DataFrame
    dim_time: DataFrame
    dim_type: DataFrame
    dim_area: DataFrame
    dim_location: DataFrame

    TABLES = ("fact_crime", "dim_date", "dim_time", "dim_crime_type", "dim_community_area",
              "dim_location")

    def tables(self) -> dict[str, DataFrame]:
        return {"fact_crime": self.fact, "dim_date": self.dim_date, "dim_time": self.dim_time,
                "dim_crime_type": self.dim_type, "dim_community_area": self.dim_area,
                "dim_location": self.dim_location}

    @classmethod
    def from_tables(cls, spark: SparkSession, layer: str) -> "Star":
        t = lambda n: spark.table(f"{layer}.{n}")
        return cls(fact=t("fact_crime"), dim_date=t("dim_date"), dim_time=t("dim_time"),
                   dim_type=t("dim_crime_type"), dim_area=t("dim_community_area"),
                   dim_location=t("dim_location"))

"""Shared helpers for the registered queries."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@dataclass
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None = None


REGISTRY: dict[str, Query] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        REGISTRY[name] = Query(fn, oracle)
        return fn
    return deco

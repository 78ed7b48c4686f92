"""The two feeds: where each lands, how it is cleaned, what it is stored as."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gridtide import schemas
from gridtide.operators import clean
from gridtide.sources import tables


@dataclass(frozen=True)
class Feed:
    report: str
    record: T.StructType
    landing_prefix: str
    window_file: str
    dataset: str
    table: tables.Table
    by_local_hour: Callable[..., DataFrame]
    by_utc_hour: Callable[..., DataFrame]


PRICE = Feed(
    schemas.PRICE_REPORT,
    schemas.PRICE_RECORD,
    schemas.PRICE_PREFIX,
    schemas.PRICE_WINDOW_FILE,
    schemas.PRICE_DATASET,
    tables.SILVER_PRICE,
    clean.price_by_local_hour,
    clean.price_by_utc_hour,
)
LOAD = Feed(
    schemas.LOAD_REPORT,
    schemas.LOAD_RECORD,
    schemas.LOAD_PREFIX,
    schemas.LOAD_WINDOW_FILE,
    schemas.LOAD_DATASET,
    tables.SILVER_LOAD,
    clean.load_by_local_hour,
    clean.load_by_utc_hour,
)

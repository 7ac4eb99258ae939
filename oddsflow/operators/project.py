"""Projection helpers: camelCase feed names to snake_case table names."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame

_CAMEL = re.compile(r"(?<=[a-z0-9])([A-Z])")


def snake_case(name: str) -> str:
    """``marketBaseRate`` -> ``market_base_rate``."""
    return _CAMEL.sub(r"_\1", name).lower()


def snake_case_columns(df: DataFrame, overrides: Mapping[str, str] | None = None) -> DataFrame:
    """Rename every top-level column to snake_case (``overrides`` win)."""
    overrides = dict(overrides or {})
    mapping = {c: overrides.get(c, snake_case(c)) for c in df.columns}
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k != v})

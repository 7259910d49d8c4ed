"""Predicates and config-driven fan-out."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing_position_with_address(lat: str, lon: str, address: Column) -> Column:
    """``(lat is null or lon is null) and address is not null``."""
    return (F.col(lat).isNull() | F.col(lon).isNull()) & address.isNotNull()


def closed_interval(c: str | Column, start, end) -> Column:
    """Both ends inclusive. Runs over consecutive intervals overlap on the boundary, so the
    consumer must be idempotent (K9 overwrites its partition)."""
    x = F.col(c) if isinstance(c, str) else c
    return x.between(F.lit(start), F.lit(end))


def at_least(c: str | Column, bound) -> Column:
    """``c >= bound``."""
    x = F.col(c) if isinstance(c, str) else c
    return x >= F.lit(bound)


@dataclass(frozen=True)
class DatasetSpec:
    """One published dataset (P16): table, output name and the range rule."""
    name: str
    table: str
    week_column: str = "semaine"
    year_column: str = "annee"
    since_day: str = "2022-01-01"
    since_year: int = 2022

    @property
    def is_annual(self) -> bool:
        return "annual" in self.table

    def predicate(self) -> Column:
        if self.is_annual:
            return F.col(self.year_column) >= F.lit(self.since_year)
        return F.col(self.week_column) >= F.lit(self.since_day).cast("date")


def from_year(c: str, year: int) -> Column:
    """P7 on a timestamp column: ``year(c) >= year`` as a range, which reaches the file scan."""
    return F.col(c) >= F.lit(f"{year:04d}-01-01 00:00:00").cast("timestamp_ntz")


def fan_out(specs: Iterable[DatasetSpec], load: Callable[[DatasetSpec], DataFrame]) -> dict[str, DataFrame]:
    """The same scan + range filter for each spec; one lazy DataFrame per dataset."""
    return {s.name: load(s).where(s.predicate()) for s in specs}

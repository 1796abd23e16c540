"""Datasets: a skeleton, tables of mixed resolution and transforms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame

from panelwright.operators.joins import join_tables
from panelwright.operators.missing import extrapolate
from panelwright.operators.reshape import sorted_columns
from panelwright.operators.shape import balance_last_t
from panelwright.panel import Panel
from panelwright.plans.transforms import Space, apply_transforms


@dataclass(frozen=True)
class Table:
    """A source table, its qualified name and key columns."""

    fqtable: str
    ids: tuple[str, ...]
    df: DataFrame

    @property
    def name(self) -> str:
        return self.fqtable.replace(".", "_")

    def cols(self) -> list[str]:
        return [c for c in self.df.columns if c not in self.ids]


@dataclass
class Dataset:
    """Declares a dataset; `df()` is one lazy plan that runs at its sink."""

    name: str
    panel: Panel
    skeleton: DataFrame
    tables: Sequence[Table]
    transforms: Mapping[str, Mapping[str, Any]] = field(default_factory=dict)
    balance: bool = False
    cols: Sequence[str] | None = None
    geometry: DataFrame | None = None
    space: Space = field(default_factory=Space)
    check: bool = False

    def joined(self) -> DataFrame:
        """All tables on the skeleton, columns by name."""
        out = join_tables(
            self.skeleton,
            [(t.df, list(t.ids)) for t in self.tables],
            self.cols,
            self.check,
        )
        return sorted_columns(out, self.panel.keys)

    def df(self, do_transforms: bool = True) -> DataFrame:
        out = self.joined()
        if self.balance:
            out = extrapolate(balance_last_t(out, self.panel), self.panel)
        if self.transforms and do_transforms:
            added: list[str] = []
            if self.geometry is not None:
                added = [c for c in self.geometry.columns if c != self.panel.group]
                out = out.join(self.geometry, self.panel.group, "left")
            out = apply_transforms(out, self.panel, self.transforms, self.space)
            out = out.drop(*added)
        return sorted_columns(out, self.panel.keys)

    def write(self, path: str, time_bucket: str | None = None) -> None:
        writer = self.df().write.mode("overwrite")
        if time_bucket:
            writer = writer.partitionBy(time_bucket)
        writer.parquet(path)

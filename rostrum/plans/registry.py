"""Named models and the object that resolves them over a set of raw tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from rostrum.functions.coerce import leading_date, safe_cast_date
from rostrum.operators.joins import broadcast_if_few
from rostrum.schemas import shape


@dataclass(frozen=True)
class Model:
    name: str
    stored: bool
    build: Callable[["Models"], DataFrame]


# Filled in definition order, in which every model comes after those it reads.
MODELS: dict[str, Model] = {}


def view(build: Callable[["Models"], DataFrame]) -> Callable[["Models"], DataFrame]:
    MODELS[build.__name__] = Model(build.__name__, False, build)
    return build


def table(build: Callable[["Models"], DataFrame]) -> Callable[["Models"], DataFrame]:
    MODELS[build.__name__] = Model(build.__name__, True, build)
    return build


class Models:
    """Resolves model names to DataFrames over the given raw tables.

    Sitting dates come as compact stamps (``20241001150000000``) in the feed,
    which the models read as NULL; ``compact_dates=True`` reads their day.
    """

    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        *,
        compact_dates: bool = False,
        keep: Callable[[str, DataFrame], DataFrame] | None = None,
    ) -> None:
        self._raw = raw
        self._built: dict[str, DataFrame] = {}
        self._few: dict[str, DataFrame] = {}
        self._compact_dates = compact_dates
        self._keep = keep

    def keeping(self, keep: Callable[[str, DataFrame], DataFrame]) -> "Models":
        """The same models, in which ``keep`` gets what several of them share once, by name.

        It returns what they then read, for example after writing it out. Short
        join sides that were counted here are not counted again.
        """
        kept = Models(self._raw, compact_dates=self._compact_dates, keep=keep)
        kept._few = self._few
        return kept

    def shared(self, name: str, build: Callable[["Models"], DataFrame]) -> DataFrame:
        """A step that several models read; no model of its own."""
        key = f"shared {name}"
        if key not in self._built:
            df = build(self)
            self._built[key] = df if self._keep is None else self._keep(name, df)
        return self._built[key]

    def few(self, name: str, build: Callable[["Models"], DataFrame]) -> DataFrame:
        """A join side that several models read; its rows are counted once.

        One that is not short is a step they share.
        """
        if name not in self._few:
            side = build(self)
            found = broadcast_if_few(side)
            if found is side:
                return self.shared(name.replace(" ", "_"), lambda m: side)
            self._few[name] = found
        return self._few[name]

    def raw(self, name: str) -> DataFrame:
        return shape(self._raw[name], name)

    def sitting_date(self, text: Column) -> Column:
        return leading_date(text) if self._compact_dates else safe_cast_date(text)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = MODELS[name].build(self)
        return self._built[name]

"""Star schema registry: facts, dimensions and the many-to-one paths between them.

A ``Star`` turns "fact F grouped by attributes A" into a DataFrame: the fact
with each attribute attached by a left equi-join on the relationship key
(E08), through a second hop for snowflaked attributes (E09). Only the key and
the requested columns of a dimension enter the join, so the scan of the
dimension is pruned to those columns. No join is hinted: the planner checks
the dimension's size against the broadcast threshold, and AQE turns a join
into a broadcast at runtime when the shuffled dimension proves small;
otherwise it stays a sort-merge join, and a fact partition swollen by one hot
or NULL key is split by AQE's skew handling.
"""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.sources.calendar import calendar_of


def _period_exprs() -> dict:
    return {
        "date": lambda d: d,
        # period numbers are int64 in the model
        "year": lambda d: F.year(d).cast("bigint"),
        "quarter": lambda d: F.quarter(d).cast("bigint"),
        "month": lambda d: F.trunc(d, "month").cast("date"),
        "month_of_year": lambda d: F.month(d).cast("bigint"),
    }


PERIODS = _period_exprs()
CALENDAR = "dim_date"


@dataclass(frozen=True)
class Where:
    """A filter and the attributes or periods it reads. It reaches the facts
    that are related to all of them; others it does not filter."""

    needs: tuple[str, ...]
    cond: Column


class LazyTables(Mapping):
    """Tables by name, each made when it is first asked for: a query pays for the
    tables it reads and for no others."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]):
        self.makers, self.made = makers, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.made:
            self.made[name] = self.makers[name]()
        return self.made[name]

    def __contains__(self, name: object) -> bool:
        return name in self.makers

    def __iter__(self) -> Iterator[str]:
        return iter(self.makers)

    def __len__(self) -> int:
        return len(self.makers)


@dataclass
class Star:
    tables: Mapping[str, DataFrame]
    # fact -> date column
    fact_dates: dict[str, str]
    # fact -> {dimension: key column on the fact (same name on the dimension)}
    fact_keys: dict[str, dict[str, str]]
    # attribute -> (dimension, column)
    attrs: dict[str, tuple[str, str]]
    # snowflake: dimension -> (parent dimension, key on the parent)
    hops: dict[str, tuple[str, str]] = field(default_factory=dict)
    # table -> columns known to be unique per row (a fact's primary key, kept
    # unique by the upsert that builds it): a distinct count of such a column
    # is a plain count, which combines map-side instead of shuffling every id
    unique: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        return self.tables[name]

    def with_table(self, name: str, df: DataFrame) -> "Star":
        t = ChainMap({name: df}, self.tables)
        return Star(t, self.fact_dates, self.fact_keys, self.attrs, self.hops, self.unique)

    def calendar(self) -> DataFrame:
        """The date dimension; without one, the days from the first to the last fact date."""
        if CALENDAR in self.tables:
            return self.tables[CALENDAR]
        dated = [(f, d) for f, d in self.fact_dates.items() if f in self.tables and self.fact_keys.get(f)]
        return calendar_of(self.tables[f].select(F.col(d).alias("date")) for f, d in dated)

    def related(self, fact: str, attr: str) -> bool:
        """True when ``attr`` is a column of ``fact`` or can be attached to it."""
        if attr in self.tables[fact].columns:
            return True
        dim = CALENDAR if attr in PERIODS else self.attrs.get(attr, (None,))[0]
        if dim == CALENDAR:
            return fact in self.fact_dates
        return (self.hops[dim][0] if dim in self.hops else dim) in self.fact_keys.get(fact, {})

    def _dim_image(self, dim: str, key: str, cols: list[str]) -> DataFrame:
        """Key + requested columns of ``dim``, hopping through a parent dimension."""
        if dim in self.hops:
            parent, pkey = self.hops[dim]
            own = self.tables[dim].select(pkey, *cols)
            return self.tables[parent].select(key, pkey).join(own, pkey, "left").drop(pkey)
        return self.tables[dim].select(key, *cols)

    def frame(self, fact: str, attrs: list[str] | tuple = (),
              where: Column | Where | list[Column | Where] | None = None) -> DataFrame:
        """Fact rows with the named attributes as columns (E08 / E09). ``where``
        is a condition over these columns, a ``Where`` over any attribute or
        period, or several of them."""
        df = self.tables[fact]
        filters = where if isinstance(where, list) else [] if where is None else [where]
        filters = [w for w in filters if not isinstance(w, Where) or all(self.related(fact, a) for a in w.needs)]
        attrs = [*attrs, *(a for w in filters if isinstance(w, Where) for a in w.needs)]
        date = self.fact_dates.get(fact)
        wanted: dict[str, list[str]] = {}
        for a in dict.fromkeys(attrs):
            if a in df.columns:
                continue
            if a in PERIODS and date is not None:
                df = df.withColumn(a, PERIODS[a](F.col(date)))
                continue
            if a not in self.attrs:
                raise KeyError(f"{fact} has no column or related attribute {a!r}")
            dim, col = self.attrs[a]
            wanted.setdefault(dim, [])
            if col not in wanted[dim]:
                wanted[dim].append(col)
        for dim, cols in wanted.items():
            via = self.hops[dim][0] if dim in self.hops else dim
            key = date if dim == CALENDAR else self.fact_keys[fact].get(via)
            if key is None:
                raise KeyError(f"{fact} has no path to {dim}")
            cols = [c for c in cols if c not in df.columns]
            if cols and dim == CALENDAR:
                df = df.join(self.calendar().select(F.col("date").alias(key), *cols), key, "left")
            elif cols:
                df = df.join(self._dim_image(dim, key, cols), key, "left")
        for a in attrs:
            if a in self.attrs and self.attrs[a][1] != a and a not in df.columns:
                df = df.withColumnRenamed(self.attrs[a][1], a)
        for w in filters:
            df = df.where(w.cond if isinstance(w, Where) else w)
        return df

"""Derived tables stored, and kept up to date by what changed in their sources."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblioscope.functions.dates import utc_instant
from biblioscope.operators.history import changed_between, rows_at
from biblioscope.plans import courses, derived
from biblioscope.sources.snapshots import Snapshots
from biblioscope.sources.tables import Tables

#: Layers from which on a refresh makes one of them.
LAYERS = 8


@dataclass(frozen=True)
class Derived:
    """A derived table: how it is made, its key, the sources that have a row for each key, and its names of codes."""

    name: str
    make: Callable[[Tables], DataFrame]
    key: str
    sort: tuple[str, ...]
    sources: tuple[str, ...]
    names: dict[str, tuple[str, str]]

    def codes(self, tables: Tables) -> DataFrame:
        """(code_table, id, name) of the code tables behind the names."""
        every = [tables[t].select(F.lit(t).alias("code_table"), F.col("id").cast("string").alias("id"), F.col("name").cast("string").alias("name")) for t in sorted({t for _, t in self.names.values()})]
        return reduce(DataFrame.union, every)


DERIVED = {
    d.name: d
    for d in (
        Derived("item_ext", derived.item_ext, "item_id", ("item_id",), ("item", "item__t"), derived.ITEM_NAMES),
        Derived("instance_ext", derived.instance_ext, "instance_id", ("instance_id",), ("instance__t", "instance"), derived.INSTANCE_NAMES),
        Derived("item_circulation_notes", derived.item_circulation_notes, "item_id", ("item_id", "ordinality"), ("item",), {}),
    )
}


#: Additive summaries by item and day, and how they are made for the days [first, last].
DAILY: dict[str, Callable[..., DataFrame]] = {"checkouts_daily": courses.checkouts_daily, "loans_daily": courses.loans_daily}


def stored(tables: Tables, root: str) -> Tables:
    """The same relations with the derived and daily tables of the newest versions below ``root``; reports read them."""
    store = Snapshots(tables.spark, root)
    return tables.having({name: store.read(name) for name in [*DERIVED, *DAILY] if store.versions(name)})


def _instant(text: str) -> str:
    """An instant in UTC in the one form that is stored and compared."""
    at = dt.datetime.fromisoformat(text)
    return (at.astimezone(dt.UTC).replace(tzinfo=None) if at.tzinfo else at).isoformat(" ", "microseconds")


def _base(tables: Tables) -> Tables:
    """The relations without stored derived tables, which would be read instead of being made."""
    return tables.without(*DERIVED)


def store_derived(tables: Tables, root: str, as_of: str | None = None) -> Tables:
    """Write the derived tables below ``root``; reports on the returned tables read them from there.

    They are built from the base tables even where ``tables`` have them stored, and become the newest
    versions when they are whole; frames on older ones stay readable.  With ``as_of``, an instant in UTC, they
    are made of the versions in force then, and ``refresh_derived`` can go on from there.
    """
    as_of = None if as_of is None else _instant(as_of)
    store, base = Snapshots(tables.spark, root), _base(tables if as_of is None else tables.as_of(as_of))
    for d in DERIVED.values():
        aside = {"codes": d.codes(base)} if d.names else {}
        store.put(d.name, d.make(base), [d.key], list(d.sort), as_of, aside)
    return stored(tables, root)


def refresh_derived(tables: Tables, root: str, upto: str, layers: int = LAYERS) -> Tables:
    """Bring the stored derived tables up to the instant ``upto`` (UTC) by what changed since they were made.

    Sources need their histories.  Versions that began or ended since then tell the changed keys; their rows
    are made anew and laid over the older ones, keys without a row now are gone.  A source is read for its
    changed versions alone, unless a key changed in one source and not in the other: the rows of such keys
    are looked up.  Where a code table gives another name, the rows that show it count as changed.
    A table that is as new as ``upto`` is left as it is, so a refresh that broke off can be run again.
    Versions are found by their instants: one that arrives with an instant before the last refresh is not.
    """
    store, upto = Snapshots(tables.spark, root), _instant(upto)
    for d in DERIVED.values():
        info = store.info(d.name)
        if info["as_of"] is None:
            raise ValueError(f"{d.name} was stored without the instant it is of: store it with as_of")
        if info["as_of"] < upto:
            _refresh(tables, store, d, info["as_of"], upto)
            if len(info["layers"]) + 1 > layers:
                store.compact(d.name)
    return stored(tables, root)


def _refresh(tables: Tables, store: Snapshots, d: Derived, since: str, upto: str) -> None:
    base = _base(tables)
    histories = {source: base[source + "__"] for source in d.sources}
    changes = {source: changed_between(history, since, upto).select(F.col("id").alias(d.key)) for source, history in histories.items()}
    keys = list(changes.values())
    aside = {}
    if d.names:
        aside["codes"] = d.codes(base)
        renamed = _renamed(store.aside(d.name, "codes"), aside["codes"])
        if not renamed.isEmpty():
            keys += [_showing(store.read(d.name), d, renamed)]
    keys = reduce(DataFrame.union, keys).where(F.col(d.key).isNotNull()).distinct().persist()
    try:
        sources = {source: _sources(history, keys, d.key, since, upto) for source, history in histories.items()}
        store.change(d.name, d.make(base.having(sources)), keys, upto, aside)
    finally:
        keys.unpersist()


def _renamed(old: DataFrame, new: DataFrame) -> DataFrame:
    """(code_table, id) of codes whose name is another now, new and lost ones included."""
    both = old.withColumnRenamed("name", "before").join(new, ["code_table", "id"], "full").where(~F.col("before").eqNullSafe(F.col("name")))
    return both.select("code_table", "id").distinct()


def _showing(rows: DataFrame, d: Derived, codes: DataFrame) -> DataFrame:
    """Keys of the stored rows that show a name of one of the codes."""
    found = []
    for column, table in sorted(set(d.names.values())):
        of_table = codes.where(F.col("code_table") == table).select(F.col("id").alias(column))
        found.append(rows.select(d.key, column).join(of_table, column, "left_semi").select(d.key))
    return reduce(DataFrame.union, found)


def _sources(history: DataFrame, keys: DataFrame, key: str, since: str, upto: str) -> DataFrame:
    """The rows of ``keys`` in force at ``upto``."""
    recent = rows_at(history.where(F.col("__start") > utc_instant(since, history.schema["__start"].dataType)), upto)
    ended = changed_between(history, since, upto).where(F.col("__end") <= utc_instant(upto, history.schema["__end"].dataType))
    settled = recent.select("id").union(ended.select("id")).withColumnRenamed("id", key)
    others = keys.join(settled, key, "left_anti")
    if others.isEmpty():
        return recent
    looked_up = rows_at(history, upto).join(others.withColumnRenamed(key, "id"), "id", "left_semi")
    return recent.unionByName(looked_up.select(*recent.columns))


def store_daily(tables: Tables, root: str, names: list[str] | None = None) -> Tables:
    """Write the daily counts below ``root``, clustered by day; reports on the returned tables read them instead of loans."""
    store, base = Snapshots(tables.spark, root), tables.without(*DAILY)
    for name in names or DAILY:
        store.put(name, DAILY[name](base), ["day"], ["day", "item_id"])
    return stored(tables, root)


def refresh_daily(tables: Tables, root: str, first: dt.date, last: dt.date, layers: int = LAYERS) -> Tables:
    """Count the days [first, last] anew, from the loans of these days alone, and let the others be.

    A day is replaced as a whole, so doing it again changes nothing.
    """
    store, base = Snapshots(tables.spark, root), tables.without(*DAILY)
    span = F.sequence(F.lit(first), F.lit(last)) if first <= last else F.array().cast("array<date>")
    days = tables.spark.range(1).select(F.explode(span).alias("day"))
    for name, make in DAILY.items():
        if store.versions(name):
            store.change(name, make(base, first, last), days)
            if len(store.info(name)["layers"]) > layers:
                store.compact(name)
    return stored(tables, root)

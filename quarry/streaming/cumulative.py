"""The k groups with most rows so far, after every count window, while the stream runs.

Three stateful steps of one append-mode query:

1. A window holds its groups' partials until all of its rows are in, then sends
   one row to each shard of the groups (an empty one too) and is forgotten.
2. A shard keeps a row of state for each of its groups (count, largest value and
   its earliest item so far) and its ``k`` leading groups. It takes windows in
   their order; one that comes early waits in state. Counts only grow, so after
   a window only the groups it touched can join the leaders: a shard looks up no
   others. It sends its leaders as of each window.
3. A window's ranks are emitted once every shard has sent its leaders, and the
   window is forgotten.

Groups are dealt to shards by a hash, so no key sees all of them; a step's row
holds at most one window's groups or ``k`` leaders. Nothing is ranked
afterwards. Null groups are a group of their own, before others of as many rows;
a null or NaN value is below all others. Groups and items pass the steps as
text (pandas keeps no nulls beside integers) and leave with their own type.
"""

from __future__ import annotations

import math
import sys
import zlib
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DataType, FractionalType, IntegralType

DEFAULT_SHARDS = 16
_FIELDS = ("grp", "n", "value", "ord", "item")
_PLAIN = "grp string, n bigint, value double, ord bigint, item string"
_ARRAYS = "grp array<string>, n array<bigint>, value array<double>, ord array<bigint>, item array<string>"

cloudpickle.register_pickle_by_value(sys.modules[__name__])

Row = tuple[str | None, int, float | None, int, str | None]       # group, rows, largest value, its earliest ordinal, that row's item


def _rises(row: Row) -> tuple:
    """Sorts by value, nulls and NaN first, then the later ordinals first."""
    value = row[2]
    known = value is not None and not math.isnan(value)
    return known, value if known else 0.0, -row[3]


def _merged(a: Row | None, b: Row) -> Row:
    if a is None:
        return b
    best = max(a, b, key=_rises)
    return (a[0], a[1] + b[1], *best[2:])


def _order(kind: DataType) -> Callable[[str], Any]:
    """What a group's text sorts by."""
    return int if isinstance(kind, IntegralType) else float if isinstance(kind, FractionalType) else str


def _leading(rows: list[Row], k: int, order: Callable[[str], Any]) -> list[Row]:
    """Most rows first, ties by group."""
    return sorted(rows, key=lambda r: (-r[1], False) if r[0] is None else (-r[1], True, order(r[0])))[:k]


def _key(group: str | None) -> str:
    return "" if group is None else f"={group}"


def _rows(columns: list) -> list[Row]:
    """Rows of Python's own values (state takes no numpy scalars)."""
    value = lambda v: None if v is None or math.isnan(v) else float(v)
    return [(g, int(n), value(v), int(o), i) for g, n, v, o, i in zip(*columns)]


def _columns(rows: list[Row]) -> list[list]:
    return [list(c) for c in zip(*rows)] if rows else [[] for _ in _FIELDS]


def _combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per (window, group) of an Arrow batch."""
    for pdf in batches:
        known = pdf.sort_values(["value", "ord"], ascending=[False, True])
        lead = known.drop_duplicates(["window_id", "grp"])
        counts = pdf.groupby(["window_id", "grp"], dropna=False).size().rename("n").reset_index()
        yield lead.merge(counts, on=["window_id", "grp"])[["window_id", *_FIELDS]].astype({"n": "int64"})


def _open_window(n: int, shards: int):
    """Step 1, per window: its shards' groups once all ``n`` rows are in."""
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held: dict[str, Row] = {}
        if state.exists:
            for row in _rows(list(state.get)):
                held[_key(row[0])] = row
        for pdf in batches:
            for row in _rows([pdf[c] for c in _FIELDS]):
                held[_key(row[0])] = _merged(held.get(_key(row[0])), row)
        if sum(r[1] for r in held.values()) < n:
            state.update(tuple(_columns(list(held.values()))))
            return
        if state.exists:
            state.remove()
        dealt: list[list[Row]] = [[] for _ in range(shards)]
        for name, row in held.items():
            dealt[zlib.crc32(name.encode()) % shards].append(row)
        yield pd.DataFrame({"window_id": key[0], "shard": range(shards),
                            **{f: [_columns(rows)[i] for rows in dealt] for i, f in enumerate(_FIELDS)}})
    return run


class _Shard(StatefulProcessor):
    """Step 2, per shard: its groups' totals, applied window by window."""

    def __init__(self, k: int, order: Callable[[str], Any]):
        self.k, self.order = k, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.place = handle.getValueState("place", "next long, waiting long")
        self.leaders = handle.getValueState("leaders", _ARRAYS)
        self.waiting = handle.getMapState("waiting", "window_id long", _ARRAYS)
        self.groups = handle.getMapState("groups", "name string", _PLAIN)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        come = {int(w): list(c) for pdf in rows for w, *c in zip(pdf["window_id"], *(pdf[f] for f in _FIELDS))}
        first, waiting = self.place.get() if self.place.exists() else (0, 0)
        at = first
        leaders = {_key(r[0]): r for r in _rows(list(self.leaders.get()))} if self.leaders.exists() else {}
        touched: dict[str, Row] = {}
        out: list[tuple[int, list[Row]]] = []
        while True:
            if at in come:
                columns = come.pop(at)
            elif waiting and self.waiting.containsKey((at,)):
                columns = list(self.waiting.getValue((at,)))
                self.waiting.removeKey((at,))
                waiting -= 1
            else:
                break
            for row in _rows(columns):
                name = _key(row[0])
                if name not in touched:
                    kept = self.groups.getValue((name,)) if self.groups.containsKey((name,)) else None
                    touched[name] = row if kept is None else _merged(_rows([[v] for v in kept])[0], row)
                else:
                    touched[name] = _merged(touched[name], row)
                leaders[name] = touched[name]
            best = _leading(list(leaders.values()), self.k, self.order)
            leaders = {_key(r[0]): r for r in best}
            out.append((at, best))
            at += 1
        for w, columns in come.items():
            self.waiting.updateValue((w,), tuple(_columns(_rows(columns))))
            waiting += 1
        for name, row in touched.items():
            self.groups.updateValue((name,), row)
        if touched:
            self.leaders.update(tuple(_columns(list(leaders.values()))))
        self.place.update((at, waiting))
        if out:
            yield pd.DataFrame({"window_id": [w for w, _ in out], "shard": key[0],
                                **{f: [_columns(r)[i] for _, r in out] for i, f in enumerate(_FIELDS)}})

    def close(self) -> None:
        pass


class _Ranks(StatefulProcessor):
    """Step 3, per window: the ranks over all shards' leaders."""

    def __init__(self, k: int, shards: int, order: Callable[[str], Any]):
        self.k, self.shards, self.order = k, shards, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", f"shards long, {_ARRAYS}")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        count, leaders = 0, []
        if self.seen.exists():
            count, *columns = self.seen.get()
            leaders = _rows(columns)
        for pdf in rows:
            count += len(pdf)
            for columns in zip(*(pdf[f] for f in _FIELDS)):
                leaders += _rows(list(columns))
        leaders = _leading(leaders, self.k, self.order)
        if count < self.shards:
            self.seen.update((count, *_columns(leaders)))
            return
        self.seen.clear()
        if leaders:
            yield pd.DataFrame({"window_id": int(key[0]), "rank": range(1, len(leaders) + 1),
                                **dict(zip(_FIELDS, _columns(leaders)))})

    def close(self) -> None:
        pass


def cumulative_top_stream(rows: DataFrame, seq: str, group: str, item: str, value: str, n: int, k: int,
                          shards: int = DEFAULT_SHARDS) -> DataFrame:
    """``(window_id, rank, grp, n, value, ord, item)`` after every complete window of ``n`` sequence numbers.

    ``seq`` numbers the rows densely from 0. Windows may come in any order and
    over any number of micro-batches; a window is emitted once it and all before
    it are complete.
    """
    kinds = rows.select(F.col(group).alias("grp"), F.col(item).alias("item")).schema
    order = _order(kinds["grp"].dataType)
    keyed = rows.select(F.floor(F.col(seq) / F.lit(n)).cast("long").alias("window_id"), F.col(group).cast("string").alias("grp"),
                        F.col(value).cast("double").alias("value"), F.col(seq).cast("long").alias("ord"),
                        F.col(item).cast("string").alias("item"))
    partial = keyed.mapInPandas(_combine, f"window_id bigint, {_PLAIN}")
    dealt = partial.groupBy("window_id").applyInPandasWithState(
        _open_window(n, shards), f"window_id bigint, shard bigint, {_ARRAYS}", _ARRAYS, "append", GroupStateTimeout.NoTimeout)
    led = dealt.groupBy("shard").transformWithStateInPandas(
        _Shard(k, order), f"window_id bigint, shard bigint, {_ARRAYS}", "Append", "None")
    ranks = led.groupBy("window_id").transformWithStateInPandas(
        _Ranks(k, shards, order), f"window_id bigint, rank bigint, {_PLAIN}", "Append", "None")
    return ranks.withColumns({c: F.col(c).cast(kinds[c].dataType) for c in ("grp", "item")})

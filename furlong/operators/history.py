"""Per-entity history: the previous race and rolling statistics of the last five."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from furlong import config as C
from furlong.functions.racing import placed
from furlong.operators.ordering import HOT_ROWS, preceding_windows


@dataclass(frozen=True)
class Rolling:
    """One rolling aggregate: output name, column, aggregate."""

    name: str
    column: str
    how: str

    def over(self, frame: WindowSpec, min_count: int) -> Column:
        value = getattr(F, self.how)(self.column).over(frame)
        if min_count <= 1:
            return value                # an aggregate of no values is null already
        return F.when(F.count(self.column).over(frame) >= min_count, value)


def rolled_stats(names: dict[str, str]) -> list[Rolling]:
    """Mean, maximum and minimum of each column, named ``{short name}{mean|max|min}``."""
    stats = {"mean": "avg", "max": "max", "min": "min"}
    return [Rolling(f"{short}{stat}", column, how) for column, short in names.items() for stat, how in stats.items()]


def with_history(df: DataFrame, entity: str, order: Sequence[str], lags: dict[str, str] | None = None,
                 rolling: Sequence[Rolling] = (), rows: int = 5, include_current: bool = False,
                 hot_rows: int = HOT_ROWS, piece_rows: int = 500_000, keys_from: DataFrame | None = None) -> DataFrame:
    """Add lagged and rolling columns; all of them share one shuffle and one sort.

    ``include_current=False`` looks at the ``rows`` rows strictly before the current one and needs one
    value; ``True`` has the current row as the last of the frame and needs two values.
    The order must be total within an entity. Rows per entity are counted in ``keys_from``, a written table with
    at least the rows of ``df``, if it is given, so that ``df`` is not computed for that.
    """
    lo, hi, min_count = (-(rows - 1), 0, 2) if include_current else (-rows, -1, 1)

    def build(spec: WindowSpec) -> dict[str, Column]:
        frame = spec.rowsBetween(lo, hi)
        out = {new: F.lag(old, 1).over(spec) for old, new in (lags or {}).items()}
        return out | {r.name: r.over(frame, min_count) for r in rolling}

    known = df.filter(F.col(entity).isNotNull())
    return preceding_windows(known, [entity], order, build, reach=rows, hot_rows=hot_rows, piece_rows=piece_rows,
                             keys_from=keys_from)


def race_history(df: DataFrame, include_current: bool = False, hot_rows: int = HOT_ROWS,
                 piece_rows: int = 500_000, keys_from: DataFrame | None = None) -> DataFrame:
    """The whole history step of the racing configuration, from rows that carry both indices.

    The previous race's ``speedindex`` and ``last_race_index`` replace the current ones under the plain
    name and are given as ``pre_…`` too. Rows without a previous speed index are dropped.
    """
    rolling = rolled_stats(C.ROLLED)
    if not include_current:
        rolling += [Rolling("resultmean", "result", "avg"), Rolling("count5sum", "count", "sum"),
                    Rolling("rentai5sum", "rentai", "sum")]
    marked = df.withColumns({"count": F.lit(1), "rentai": placed(F.col("result"))})
    out = with_history(marked, "horsename", ["days", "raceid"], C.LAGGED, rolling,
                       include_current=include_current, hot_rows=hot_rows, piece_rows=piece_rows, keys_from=keys_from)
    indices = ("speedindex", "last_race_index")
    return out.withColumns({c: F.col(f"pre_{c}") for c in indices}).filter(F.col("speedindex").isNotNull())


def history_table(df: DataFrame, include_current: bool = False) -> DataFrame:
    """Only the key and the history columns of :func:`race_history`, to be joined to entries."""
    known = set(df.columns) - {"speedindex", "last_race_index", "raceid"}
    out = race_history(df, include_current)
    return out.select(*[c for c in out.columns if c not in known and c not in ("count", "rentai")])


def with_history_table(entries: DataFrame, table: DataFrame) -> DataFrame:
    """Attach a history table by entry key; entries without history are dropped."""
    return entries.drop("speedindex", "last_race_index").join(table, ["raceid"], "inner")

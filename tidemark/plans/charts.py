"""Chart queries composed over named datasets.

A chart is a second aggregate over a dataset's DataFrame, so its filters and columns are planned together with the
dataset and reach the scan.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..operators.filters import apply_filters
from ..operators.ids import assign_ids
from ..operators.ranking import top_k
from ..session import checkpointed

# The row limit that the dashboard's table view asks for, and time grains by their ISO names.
TABLE_ROWS = 5000
GRAINS = {"PT1H": "hour", "P1D": "day"}

AGGREGATES = ("SUM", "MAX", "MIN", "AVG", "COUNT")


@dataclass(frozen=True)
class Metric:
    """A named aggregate: a column with an aggregate name, or an SQL expression."""

    label: str
    expression: str

    @staticmethod
    def of(column: str, aggregate: str = "SUM", label: str | None = None) -> "Metric":
        if aggregate == "COUNT_DISTINCT":
            return Metric(label or column, f"COUNT(DISTINCT `{column}`)")
        if aggregate not in AGGREGATES:
            raise ValueError(f"unknown aggregate {aggregate}")
        return Metric(label or column, f"{aggregate}(`{column}`)")

    @staticmethod
    def sql(expression: str, label: str) -> "Metric":
        return Metric(label, expression)

    @property
    def column(self) -> Column:
        return F.expr(self.expression)


ROW_COUNT = Metric("count", "COUNT(*)")


@dataclass(frozen=True)
class Roles:
    """What a dataset's columns may be used for."""

    times: tuple[str, ...] = ()
    main_time: str | None = None
    not_groupable: tuple[str, ...] = ()
    not_filterable: tuple[str, ...] = ()

    @property
    def time(self) -> str | None:
        """The flagged time column, else the first one."""
        return self.main_time or (self.times[0] if self.times else None)


# Column roles of the star tables.
STAR_ROLES = {
    "dim_users": Roles(times=("signup_date",)),
    "dim_features": Roles(not_groupable=("description",)),
    "dim_campaigns": Roles(),
    "fact_events": Roles(times=("event_time",), main_time="event_time", not_groupable=("event_id",)),
    "fact_conversions": Roles(
        times=("conversion_time",), main_time="conversion_time", not_groupable=("conversion_id", "revenue")
    ),
}


@dataclass(frozen=True)
class Dataset:
    df: DataFrame
    roles: Roles = field(default_factory=Roles)

    def check_groupable(self, keys: list[str]) -> None:
        for key in keys:
            if key not in self.df.columns:
                raise ValueError(f"unknown column {key}")
            if key in self.roles.not_groupable:
                raise ValueError(f"column {key} cannot be grouped by")

    def filtered(self, selected: dict[str, list]) -> "Dataset":
        for key in selected:
            if key in self.roles.not_filterable:
                raise ValueError(f"column {key} cannot be filtered")
        return Dataset(apply_filters(self.df, selected), self.roles)


def time_bucket(dataset: Dataset, x: str, grain: str | None) -> Column:
    if grain is None:
        return F.col(x)
    kind = dataset.df.schema[x].dataType
    if isinstance(kind, T.StringType):
        # Bucketed labels such as '2024-01-01 13:00:00' come as text.
        return F.date_trunc(GRAINS[grain], F.col(x).try_cast("timestamp_ntz")).cast("timestamp_ntz")
    return F.date_trunc(GRAINS[grain], F.col(x)).cast("timestamp_ntz")


def chart_query(
    dataset: Dataset,
    metrics: list[Metric],
    groupby: list[str] = (),
    x: str | None = None,
    grain: str | None = None,
    limit: int | None = None,
    order_desc: bool = True,
) -> DataFrame:
    """Aggregate by ``x`` (in time buckets when a grain is given) and ``groupby``, first metric first.

    Without a limit all rows come, sorted; with one, as many as the caller asks for.
    """
    keys = ([x] if x else []) + list(groupby)
    dataset.check_groupable(keys)
    grouping = [time_bucket(dataset, x, grain).alias(x)] if x else []
    grouped = dataset.df.groupBy(*grouping, *groupby).agg(*[m.column.alias(m.label) for m in metrics])
    if not keys:
        return grouped
    first = F.desc_nulls_last(metrics[0].label) if order_desc else F.asc_nulls_last(metrics[0].label)
    order = [first, *[F.asc_nulls_last(k) for k in keys]]
    return grouped.orderBy(*order) if limit is None else top_k(grouped, limit, *order)


def big_number(dataset: Dataset, metric: Metric) -> DataFrame:
    return chart_query(dataset, [metric])


def trend(dataset: Dataset, metric: Metric = ROW_COUNT, grain: str = "P1D") -> DataFrame:
    """A metric over the dataset's main time column, oldest first."""
    if dataset.roles.time is None:
        raise ValueError("the dataset has no time column")
    line = chart_query(dataset, [metric], x=dataset.roles.time, grain=grain)
    return line.orderBy(F.asc_nulls_last(dataset.roles.time))


def stacked_series(dataset: Dataset, metric: Metric, x: str, series: str, grain: str | None = None, limit: int | None = None) -> DataFrame:
    """Values per ``x`` and series, with the offsets at which each piece of the stack starts and ends.

    Offsets count all pieces; a limit then leaves out the smallest.
    """
    pieces = chart_query(dataset, [metric], [series], x, grain)
    window = Window.partitionBy(x).orderBy(F.asc_nulls_last(series)).rowsBetween(Window.unboundedPreceding, 0)
    top = F.sum(metric.label).over(window)
    stacked = pieces.withColumn("stack_end", top).withColumn("stack_start", F.col("stack_end") - F.col(metric.label))
    return _largest(stacked, metric, [x, series], limit)


def _largest(df: DataFrame, metric: Metric, keys: list[str], limit: int | None) -> DataFrame:
    if limit is None:
        return df
    return top_k(df, limit, F.desc_nulls_last(metric.label), *[F.asc_nulls_last(k) for k in keys])


def heatmap(dataset: Dataset, metric: Metric, x: str, y: str, limit: int | None = None) -> DataFrame:
    """Cells with the value scaled to 0..1 within each ``y`` (null when all its values are equal).

    ``x_position`` is alphabetical; ``y_position`` counts from the largest total. Scales and positions come from all
    cells; a limit then leaves out the smallest.
    """
    dataset.check_groupable([x, y])
    # Written once: the axes, their ranges and the cells themselves all come from it.
    cells = checkpointed(dataset.df.sparkSession, dataset.df.groupBy(x, y).agg(metric.column.alias(metric.label)))
    value = F.col(metric.label)
    ranges = cells.groupBy(y).agg(
        F.min(metric.label).alias("low"), F.max(metric.label).alias("high"), F.sum(metric.label).alias("total")
    )
    xs = _positions(cells.select(x).distinct(), [F.asc_nulls_last(x)], "x_position")
    ys = _positions(ranges, [F.desc_nulls_last("total"), F.asc_nulls_last(y)], "y_position")
    scaled = (value - F.col("low")) / F.nullif(F.col("high") - F.col("low"), F.lit(0))
    placed = (
        cells.join(ys.withColumnRenamed(y, "_y"), F.col(y).eqNullSafe(F.col("_y")))
        .join(xs.withColumnRenamed(x, "_x"), F.col(x).eqNullSafe(F.col("_x")))
        .select(x, y, metric.label, scaled.cast("double").alias("scaled"), "x_position", "y_position")
    )
    return _largest(placed, metric, [x, y], limit)


def _positions(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Positions of axis values, from 1, however many there are."""
    return assign_ids(df, 0, order, name)


def shares(dataset: Dataset, metric: Metric, category: str) -> DataFrame:
    """Value and share of the whole per category."""
    parts = dataset.df.groupBy(category).agg(metric.column.alias(metric.label))
    total = parts.agg(F.sum(metric.label).alias("total")).scalar()
    return parts.withColumn("share", F.col(metric.label) / F.nullif(total, F.lit(0)))

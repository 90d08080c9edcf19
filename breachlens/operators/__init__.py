"""Table operators built from DataFrame joins, groupings and windows."""

from breachlens.operators.dedupe import keep_first
from breachlens.operators.frequency import attach_frequency, bounded_columns, category_counts, look_up
from breachlens.operators.order_stats import OrderStatistic, order_statistics, quantiles

__all__ = [
    "OrderStatistic",
    "attach_frequency",
    "bounded_columns",
    "category_counts",
    "keep_first",
    "look_up",
    "order_statistics",
    "quantiles",
]

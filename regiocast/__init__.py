"""regiocast: regional daily-count analytics as Spark jobs.

The analytics take DataFrames and return DataFrames:

    from regiocast import monthly_mean_per_center, top_regions_by_forecast, coverage_percent, cluster
"""

from regiocast.operators.clustering import cluster
from regiocast.operators.regression import linear_fit, predict_at
from regiocast.plans.coverage import coverage_clusters, coverage_percent, forecast_at_date
from regiocast.plans.forecast import forecast_next_month, top_regions_by_forecast, top_regions_by_forecast_rounded
from regiocast.plans.monthly_mean import monthly_mean_per_center
from regiocast.plans.reports import category_trend, region_ranking

__version__ = "0.1.0"

__all__ = [
    "category_trend",
    "cluster",
    "coverage_clusters",
    "coverage_percent",
    "forecast_at_date",
    "forecast_next_month",
    "linear_fit",
    "monthly_mean_per_center",
    "predict_at",
    "region_ranking",
    "top_regions_by_forecast",
    "top_regions_by_forecast_rounded",
]

"""Forecasts with boosted trees. SQL grows one tree beside ours; of many trees it checks the bounds."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourloom.plans.boosting import train_boosted, with_prediction
from hourloom.plans.forecast import forecast, train, train_missing, tree_predictor
from hourloom.shared import written
from hourloom.workload import adapters
from hourloom.workload.marts import _SITES, START, site_features, site_future
from hourloom.workload.registry import query
from hourloom.workload.sql import over


@query()
def forecast_trees(spark, folder):
    """Boosted trees fitted to all sites before the start, then 14 days for every site."""
    cal = adapters.calendar(spark, folder)
    features = written(site_features(spark, folder), "features")  # for the training and the forecast
    model = train(features, START)
    return forecast(
        tree_predictor(model), features, site_future(spark, folder, cal), START, ["user_id"]
    )


# The cuts tried per input of the tree that SQL grows as well.
CUTS = {
    "hour": [5, 11, 17],
    "is_weekend": [0],
    "temperature_2m": [20, 40, 60],
    "precipitation": [40, 80, 120],
    "lag_1_day": [30, 60, 90],
    "lag_7_day": [30, 60, 90],
}
_SCALE = 1024.0


def _level(name: str, rows: str) -> dict[str, str]:
    """The best cut of each node of some rows, and the rows in their child nodes."""
    return {
        f"{name}_tried": f"""SELECT node, f, c, side, sum(y) FILTER (goes_left) AS gl, count(*) FILTER (goes_left) AS nl,
            sum(y) AS g, count(*) AS n
          FROM (SELECT node, y, f, c, side, coalesce(x[f] <= edge, side = 0) AS goes_left
            FROM {rows} CROSS JOIN cuts CROSS JOIN (VALUES (0), (1)) s(side)) GROUP BY ALL""",
        f"{name}_best": f"""SELECT DISTINCT ON (node) node, f, c, side FROM (
            SELECT *, gl::DOUBLE * gl::DOUBLE / (nl + 1.0::DOUBLE)
              + (g - gl)::DOUBLE * (g - gl)::DOUBLE / (n - nl + 1.0::DOUBLE)
              - g::DOUBLE * g::DOUBLE / (n + 1.0::DOUBLE) AS gain
            FROM {name}_tried WHERE nl > 0 AND nl < n) WHERE gain > 0
          ORDER BY node, gain DESC, f, c, side""",
        name: f"""SELECT r.* REPLACE (CASE WHEN b.f IS NULL THEN r.node
            ELSE 2 * r.node + if(coalesce(x[b.f] <= edge, b.side = 0), 0, 1) END AS node)
          FROM {rows} r LEFT JOIN {name}_best b ON b.node = r.node
          LEFT JOIN cuts k ON k.f = b.f AND k.c = b.c""",
    }


@query(
    over(
        "site_energy site_weather mapping calendar",
        f"""SELECT user_id, date, hour, (sum(y) OVER (PARTITION BY node))::DOUBLE
          / (count(*) OVER (PARTITION BY node) + 1.0::DOUBLE) / {_SCALE}::DOUBLE AS prediction FROM second""",
        mart=_SITES,
        cuts="SELECT f, unnest(range(1, len(e) + 1)) AS c, unnest(e) AS edge FROM (SELECT * FROM (VALUES "
        + ", ".join(f"({i}, [{', '.join(f'{x}::DOUBLE' for x in e)}, 'inf'::DOUBLE])" for i, e in enumerate(CUTS.values(), 1))
        + ") t(f, e))",
        labelled=f"""SELECT user_id, date, hour, 1 AS node, CAST(round_even(actual_power * {_SCALE}, 0) AS BIGINT) AS y,
          [{', '.join(f'CAST({c} AS DOUBLE)' for c in CUTS)}] AS x FROM mart WHERE actual_power IS NOT NULL""",
        **_level("first", "labelled"),
        **_level("second", "first"),
    )
)
def tree_of_depth_two(spark, folder):
    """One tree, each cut tried with the missing values on either side."""
    features = site_features(spark, folder)
    edges = {c: list(map(float, e)) for c, e in CUTS.items()}
    model = train_boosted(features, list(CUTS), "actual_power", 1, 2, 1.0, edges=edges, base=0.0, scale=_SCALE)
    return with_prediction(features.where("actual_power IS NOT NULL"), model).select("user_id", "date", "hour", "prediction")


@query(
    over(
        "site_energy",
        """SELECT user_id, 336::BIGINT AS hours, 0::BIGINT AS missing, 0::BIGINT AS out_of_bounds
        FROM (SELECT DISTINCT user_id FROM events)""",
    )
)
def forecast_boosted_bounds(spark, folder):
    """14 days for every site by trees that know missing values: all there, and none farther than a
    tenth of the range of all readings from them."""
    cal = adapters.calendar(spark, folder)
    features = written(site_features(spark, folder), "features")  # for the training, the forecast and the range
    model = train_missing(features, START, trees=20, depth=4, rate=0.2)
    made = forecast(model, features, site_future(spark, folder, cal), START, ["user_id"])
    seen = features.where(F.col("date") < F.lit(START)).agg(F.min("actual_power").alias("lo"), F.max("actual_power").alias("hi")).first()
    room = (seen["hi"] - seen["lo"]) / 10
    value = F.col("prediction")
    return made.groupBy("user_id").agg(
        F.count("*").alias("hours"),
        F.count_if(value.isNull() | F.isnan(value)).alias("missing"),
        F.count_if((value < seen["lo"] - room) | (value > seen["hi"] + room)).alias("out_of_bounds"),
    )

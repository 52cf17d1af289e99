"""The README quick start, end to end, on text feeds derived from the tables."""

from regiocast import cluster, coverage_percent, monthly_mean_per_center, top_regions_by_forecast
from regiocast.sources import schemas, tables
from regiocast.sources.landing import land

from conftest import SF_SMOKE


def _feed(df, path):
    df.selectExpr(*[f"CAST(`{c}` AS STRING) AS `{c}`" for c in df.columns]).write.option("header", True).csv(path)


def test_quick_start(spark, scratch):
    _feed(tables.summary(spark, SF_SMOKE, qualified=True), f"{scratch}/feeds/summary")
    _feed(tables.centers(spark, SF_SMOKE, qualified=True), f"{scratch}/feeds/centers")
    _feed(
        tables.doses(spark, SF_SMOKE).selectExpr("date AS day", "'S' AS maker", "region AS area", "age AS band", "women + 7 AS m", "women AS f"),
        f"{scratch}/feeds/doses",
    )
    _feed(tables.population(spark, SF_SMOKE), f"{scratch}/feeds/population")

    def landed(name, raw, typed):
        return land(spark, f"{scratch}/feeds/{name}", f"{scratch}/landed/{name}", raw, typed)

    summary = landed("summary", schemas.SUMMARY_RAW, schemas.SUMMARY)
    centers = landed("centers", schemas.CENTERS_RAW, schemas.CENTERS)
    doses = landed("doses", schemas.DOSES_RAW, schemas.DOSES)
    population = landed("population", schemas.POPULATION_RAW, schemas.POPULATION)

    assert monthly_mean_per_center(summary, centers, "1995-12-31").count() > 0
    assert top_regions_by_forecast(doses, "1995-12-31").count() > 0
    assert doses.groupBy().sum("women").first() == tables.doses(spark, SF_SMOKE).groupBy().sum("women").first()
    q3 = coverage_percent(summary, population, "1994-12-26", "2002-02-13")
    assert q3.count() == 10
    assert {r.prediction for r in cluster(q3, ["percent"], 4, "bisecting", order_by=["region"]).collect()} == {0, 1, 2, 3}

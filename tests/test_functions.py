import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from rainledger import functions as fn
from rainledger.plans import rfm, weather


def points(values, rules, cuts):
    """Ladder results just below, at and just above each cut, and for NULL."""
    comparison, steps = rules
    inputs = [x for cut in cuts for x in (cut - 0.01, float(cut), cut + 0.01)] + [None]
    return values("double", inputs, lambda c: fn.ladder(F.col(c), comparison, steps, 0))


@pytest.mark.parametrize(
    "rules, cuts, expected",
    [
        # (measure rules, cuts in order, points below / at / above each cut, then NULL)
        (weather.CROP_STRESS["temperature_2m_max_c"], [31, 33, 35, 38], [0, 10, 10, 10, 20, 20, 20, 30, 30, 30, 40, 40, 0]),
        (weather.CROP_STRESS["soil_moisture_avg"], [0.1, 0.15, 0.2, 0.25], [35, 35, 25, 25, 25, 15, 15, 15, 8, 8, 8, 0, 0]),
        (weather.CROP_STRESS["evapotranspiration_mm"], [2, 4, 6, 8], [0, 5, 5, 5, 10, 10, 10, 18, 18, 18, 25, 25, 0]),
        (weather.DROUGHT["precipitation_30d_mm"], [30, 60, 100, 150], [25, 18, 18, 18, 10, 10, 10, 5, 5, 5, 0, 0, 0]),
        (weather.DROUGHT["temperature_2m_max_c"], [31, 33, 35, 38], [0, 5, 5, 5, 10, 10, 10, 18, 18, 18, 25, 25, 0]),
        (weather.DROUGHT["soil_moisture_avg"], [0.1, 0.15, 0.2, 0.25], [25, 25, 18, 18, 18, 10, 10, 10, 5, 5, 5, 0, 0]),
        (weather.DROUGHT["evapotranspiration_30d_mm"], [60, 100, 150, 200], [0, 5, 5, 5, 10, 10, 10, 18, 18, 18, 25, 25, 0]),
        (weather.FIRE["temperature_2m_max_c"], [31, 33, 35, 38], [0, 5, 5, 5, 10, 10, 10, 15, 15, 15, 20, 20, 0]),
        (weather.FIRE["relative_humidity_min_pct"], [30, 40, 50, 60], [20, 20, 15, 15, 15, 10, 10, 10, 5, 5, 5, 0, 0]),
        (weather.FIRE["wind_speed_10m_max_kmh"], [15, 20, 25, 30], [0, 3, 3, 3, 7, 7, 7, 11, 11, 11, 15, 15, 0]),
    ],
)
def test_score_ladders(values, rules, cuts, expected):
    assert points(values, rules, cuts) == expected


def test_every_score_reaches_but_never_passes_100():
    def best(scheme):
        return sum(max(p for _, p in steps) for _, steps in scheme.values())

    assert best(weather.CROP_STRESS) == 100
    assert best(weather.DROUGHT) == 100
    assert float(weather.FIRE_DROUGHT_SHARE) * 100 + best(weather.FIRE) + weather.PEATLAND_POINTS == 100


def test_risk_levels(values):
    scores = [24.9, 25.0, 49.9, 50.0, 74.9, 75.0]
    assert values("double", scores, lambda c: fn.risk_level(F.col(c))) == [
        "low",
        "medium",
        "medium",
        "high",
        "high",
        "extreme",
    ]


def test_segments(values):
    def label(preset):
        return lambda c: fn.ladder(F.col(c), ">=", rfm.PRESETS[preset].segments, rfm.PRESETS[preset].other)

    sums = [3, 4, 6, 7, 9, 10, 12]
    assert values("int", sums, label("v2")) == [
        "Lost",
        "At Risk",
        "At Risk",
        "Loyal",
        "Loyal",
        "Champions",
        "Champions",
    ]
    assert values("int", [3, 5, 6, 8, 9], label("v1")) == ["At Risk", "At Risk", "Loyal", "Loyal", "Champions"]


def test_ladder_without_rules_is_refused(spark):
    with pytest.raises(ValueError):
        fn.ladder(F.lit(1), ">=", [], 0)


def test_clamp_and_flag(values):
    assert values("int", [99, 100, 101], lambda c: fn.clamp(F.col(c))) == [99, 100, 100]
    assert values("boolean", [True, False, None], lambda c: fn.flag_points(F.col(c), 5)) == [5, 0, 0]


def test_calendar(values):
    days = [dt.date(2026, 1, 9), dt.date(2026, 5, 31), dt.date(2026, 6, 1), dt.date(2026, 12, 31), None]
    assert values("date", days, lambda c: fn.date_key(F.col(c))) == [20260109, 20260531, 20260601, 20261231, None]
    assert values("date", days[:4], lambda c: fn.month_name(F.col(c))) == ["January", "May", "June", "December"]
    assert values("date", days[:4], lambda c: fn.season(F.col(c))) == ["wet", "transition", "dry", "wet"]


def test_full_days_are_elapsed_days(values):
    stamps = [dt.datetime(2026, 1, 1, 12), dt.datetime(2026, 1, 2, 0, 0, 1), dt.datetime(2026, 1, 3)]
    end = F.lit("2026-01-03").cast("timestamp_ntz")
    assert values("timestamp_ntz", stamps, lambda c: fn.full_days_between(F.col(c), end)) == [1, 0, 0]


@pytest.mark.parametrize(
    "total, discount, expected",
    [(None, None, "20"), (None, "0.1", "18"), ("7.5", "0.1", "7.5")],
)
def test_line_amount(spark, total, discount, expected):
    row = spark.range(1).select(
        fn.line_amount(
            F.lit(total).cast("decimal(12,2)"),
            F.lit(2),
            F.lit(10).cast("decimal(10,2)"),
            F.lit(discount).cast("decimal(4,2)"),
        )
    )
    assert row.first()[0] == D(expected)


def test_means_and_margin(spark):
    df = spark.createDataFrame([(D("1.00"),), (D("1.01"),), (None,)], "x decimal(18,2)")
    row = df.agg(
        fn.rounded_mean(F.sum("x"), F.count("x")).alias("m"), fn.exact_mean(F.col("x")).alias("e")
    ).first()
    assert (row["m"], row["e"]) == (D("1.01"), 1.005)
    none = df.where("x > 5").agg(fn.rounded_mean(F.sum("x"), F.count("x")), fn.exact_mean(F.col("x"))).first()
    assert tuple(none) == (None, None)
    price = spark.createDataFrame([(D("3.00"), D("2.00")), (D("0.00"), D("1.00"))], "p decimal(10,2), c decimal(10,2)")
    percent = [r[0] for r in price.select(fn.margin_percent(F.col("p"), F.col("c"))).collect()]
    assert percent == [D("33.33"), None]
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        price.select(fn.margin_percent(F.col("p"), F.col("c"), guard=False)).collect()


def test_names_and_cells(spark):
    rows = [("Ann", "Lee", 1), ("Ann", None, 2), (" ", " ", 3), (None, None, 4)]
    df = spark.createDataFrame(rows, "f string, l string, i int").orderBy("i")
    names = [r[0] for r in df.select(fn.display_name(F.col("f"), F.col("l"), F.col("i"))).collect()]
    assert names == ["Ann Lee", "Store Customer #2", "Store Customer #3", "Store Customer #4"]
    cells = spark.createDataFrame([(4, 3, 1), (1, None, 2)], "a int, b int, c int")
    assert [r[0] for r in cells.select(fn.cell_code(F.col("a"), F.col("b"), F.col("c"))).collect()] == ["4-3-1", None]


def test_drop_timezones(spark):
    df = spark.sql("SELECT TIMESTAMP '2026-01-01 07:00:00+02:00' AS aware, TIMESTAMP_NTZ '2026-01-01 07:00:00' AS plain")
    out = fn.drop_timezones(df)
    assert dict(out.dtypes) == {"aware": "timestamp_ntz", "plain": "timestamp_ntz"}
    assert tuple(out.first()) == (dt.datetime(2026, 1, 1, 5), dt.datetime(2026, 1, 1, 7))

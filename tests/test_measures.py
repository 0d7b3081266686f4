import random
from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal

import numpy as np

from conftest import rows
from vigie.functions import measures as M
from vigie.functions import temporal as T
from vigie.operators.quantiles import middle_values


def test_half_up_equals_decimal_rounding(spark):
    rng = random.Random(7)
    pairs = [(rng.randint(-10**6, 10**6), rng.randint(1, 5000)) for _ in range(2000)]
    pairs += [(1, 8), (-1, 8), (2469, 20000), (5, 1000), (-5, 1000), (0, 3)]
    df = spark.createDataFrame(pairs, "n long, d long")
    for places, wide in ((2, False), (3, False), (2, True)):
        got = rows(df.selectExpr("n", "d", f"{M.half_up('n', 'd', places, wide=wide)} AS r"))
        for row in got:
            exact = (Decimal(row["n"]) / Decimal(row["d"])).quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP)
            assert row["r"] == float(exact), row


def test_half_up_without_denominator(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (None, 2)], "n long, d long")
    assert [r["r"] for r in rows(df.selectExpr(f"{M.percent('n', 'd')} AS r"))] == [None, None, None]


def test_wide_sum_survives_what_a_long_cannot(spark):
    df = spark.createDataFrame([(9 * 10**18,), (9 * 10**18,), (-5,)], "v long")
    total = df.selectExpr(f"{M.wide_sum('v')} AS s").collect()[0]["s"]
    assert int(total) == 18 * 10**18 - 5


def test_rounding_of_doubles(spark):
    df = spark.createDataFrame([(0.125,), (-0.125,), (2.5,), (-0.001,)], "v double")
    got = rows(df.selectExpr(f"{M.round_even('v', 2)} AS e", f"{M.round_away('v', 2)} AS a"))
    assert [r["e"] for r in got] == [0.12, -0.12, 2.5, -0.0]
    assert [r["a"] for r in got] == [0.13, -0.13, 2.5, 0.0]


def test_calendar_does_not_use_the_session_zone(spark):
    df = spark.createDataFrame([(datetime(2020, 3, 29, 2, 30), datetime(2020, 3, 30, 2, 30))], "a timestamp_ntz, b timestamp_ntz")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Europe/Paris", "Pacific/Noumea"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            row = df.selectExpr(
                f"{T.seconds_between('a', 'b')} AS s", f"{T.month_start('a')} AS m", f"{T.weekday_sunday0('a')} AS w",
                f"{T.weekday_padded('a')} AS n", f"{T.week_closing_sunday('b')} AS c",
            ).collect()[0]
            assert (row.s, row.m, row.w, row.n, row.c) == (86400, date(2020, 3, 1), 0, "Sunday   ", date(2020, 4, 5))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_middle_values_equal_brute_force_under_skew(spark):
    rng = random.Random(3)
    data = [("hot", rng.randint(-4000, 90000)) for _ in range(3000)]
    data += [(f"k{i % 40}", rng.randint(0, 50)) for i in range(500)]
    data += [(None, v) for v in (5, 9, 9, 100)] + [("empty", None), ("one", 7)]
    df = spark.createDataFrame(data, "k string, v long")
    expected = {}
    for k, v in data:
        if v is not None:
            expected.setdefault(k, []).append(v)
    got = {r["k"]: (r["lo"] + r["hi"]) / 2 for r in rows(middle_values(df, ["k"], "v", width=100))}
    assert got == {k: float(np.median(v)) for k, v in expected.items()}
    everything = [v for _, v in data if v is not None]
    one = middle_values(df, [], "v", width=1000).collect()[0]
    assert (one.lo + one.hi) / 2 == float(np.median(everything))


def test_middle_values_of_nothing(spark):
    df = spark.createDataFrame([], "k string, v long")
    assert middle_values(df, ["k"], "v").count() == 0
    row = middle_values(df, [], "v").collect()[0]
    assert (row.lo, row.hi) == (None, None)

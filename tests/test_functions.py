import datetime as dt
import math

from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark import constants as K
from tidemark.functions import calendar as C
from tidemark.functions import hashing, money, scores


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_calendar(spark):
    day = F.lit(dt.date(2024, 3, 31))
    assert one(spark, C.month_floor(day), C.month_shift(day, -13), C.days_in_month(day)) == (
        dt.date(2024, 3, 1), dt.date(2023, 2, 1), 31)
    months = one(spark, C.month_sequence(dt.date(2024, 11, 1), 3))[0]
    assert months == [dt.date(2024, 11, 1), dt.date(2024, 12, 1), dt.date(2025, 1, 1)]
    assert one(spark, C.tenure_months(F.lit(dt.date(2025, 1, 1)), F.lit(dt.date(2023, 11, 30)))) == (14,)


def test_five_years_from_a_leap_day(spark):
    def after(day, years):
        return one(spark, C.plus_years_leap(F.lit(day), years))[0]

    assert after(dt.date(2024, 2, 29), 5) == dt.date(2029, 3, 1)
    assert after(dt.date(2024, 2, 29), 4) == dt.date(2028, 2, 29)
    assert after(dt.date(2023, 2, 28), 5) == dt.date(2028, 2, 28)


def test_instalments(spark):
    zero_rate = money.emi_amount(F.lit(1200), F.lit(0), F.lit(12))
    emi = money.emi_amount(F.lit(50000), F.lit(15.0), F.lit(12))
    assert one(spark, zero_rate) == (100.0,)
    paid = one(spark, emi)[0] * 12
    assert 4000 < paid - 50000 < 4300
    back = money.max_principal(emi, F.lit(15.0), F.lit(12))
    assert abs(one(spark, back)[0] - 50000) < 0.1
    assert one(spark, money.max_principal(F.lit(100.0), F.lit(0), F.lit(12))) == (1200.0,)
    left = money.outstanding_after(F.lit(50000), F.lit(15.0), emi, F.lit(13))
    assert one(spark, left) == (0.0,)


def test_credit_limit_rounds_half_to_even_above_the_floor(spark):
    limit = [one(spark, money.credit_limit(F.lit(v)))[0] for v in (50000.0, 90000.0, 12345.0)]
    assert [int(x) for x in limit] == [12000, 22000, 10000]


def test_ratio_change(spark):
    def change(recent, prior):
        return one(spark, scores.ratio_change(F.lit(recent).cast("double"), F.lit(prior).cast("double")))[0]

    assert change(None, 5.0) == -1.0
    assert change(3.0, 0.0) == 0.0 and change(3.0, -10.0) == 0.0 and change(3.0, None) == 0.0
    assert change(4.0, 3.0) == 0.3333


def test_sigmoid_and_logit(spark):
    values = [one(spark, scores.sigmoid(F.lit(float(x))))[0] for x in (0, 100, -100, -1000)]
    assert values[0] == 0.5 and values[1] > 0.999999 and values[2] < 1e-6 and values[3] == 0.0
    assert math.isclose(one(spark, scores.logit(F.lit(0.25)))[0], math.log(1 / 3))
    assert math.isclose(one(spark, scores.logit(F.lit(0.0)))[0], math.log(1e-5 / (1 - 1e-5)))


def test_clip_score_rounds_half_to_even(spark):
    got = [one(spark, scores.clip_score(F.lit(x), 0, 10))[0] for x in (2.5, 3.5, -4.0, 12.0)]
    assert got == [2, 4, 0, 10]


def test_uniform_is_spread_and_repeatable(spark):
    draws = spark.range(100_000).select(hashing.uniform_millionths(F.col("id"), 42).alias("u"))
    low = draws.filter("u < 200000").count() / 100_000
    assert abs(low - 0.2) < 0.01
    assert draws.agg(F.min("u"), F.max("u")).first()[0] >= 0
    again = spark.range(100_000).repartition(7).select(
        F.sum(hashing.uniform_millionths(F.col("id"), 42)))
    assert again.first()[0] == draws.agg(F.sum("u")).first()[0]


def test_weighted_choice_follows_the_weights(spark):
    picked = spark.range(60_000).select(
        hashing.weighted_choice(F.col("id"), 7, [("a", 1), ("b", 2), ("c", 3)]).alias("v"))
    share = dict(rows(picked.groupBy("v").agg(F.count("*") / 60_000)))
    assert abs(share["a"] - 1 / 6) < 0.02 and abs(share["c"] - 1 / 2) < 0.02


def test_persona_constants():
    assert len(K.PERSONAS) == 6 and len(K.EVENTS) == 12
    by_name = {p[0]: p for p in K.PERSONAS}
    assert by_name["complaint_prone_churner"][1] == min(p[1] for p in K.PERSONAS)
    assert all(0 < p[2] < p[3] < 0.1 for p in K.PERSONAS)

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from varve.functions import (
    HOUR_MINUTE,
    day_bound,
    guard,
    label,
    locale_double,
    null_token,
    safe,
    strict_date,
    trace_flag,
    trace_value,
)
from varve.plans import layouts


def evaluate(spark, texts, *functions):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
    out = df.orderBy("i").select(*[f("c").alias(f"v{n}") for n, f in enumerate(functions)])
    values = [tuple(r) for r in out.collect()]
    return [v[0] for v in values] if len(functions) == 1 else values


def test_safe_double_gives_null_for_dirty_text(spark):
    texts = [" 45 ", " ", "", "18,4", "Ip", "***", None, "-.18", "1e3"]
    got = evaluate(spark, texts, lambda c: safe(c, "double"))
    assert got == [45.0, None, None, None, None, None, None, -0.18, 1000.0]


def test_safe_double_accepts_nan_and_infinity_as_values(spark):
    nan, inf = evaluate(spark, ["NaN", "inf"], lambda c: safe(c, "double"))
    assert math.isnan(nan) and math.isinf(inf)


def test_safe_int_refuses_fractions(spark):
    assert evaluate(spark, ["18.4", "45.0", " 7 ", "x"], lambda c: safe(c, "int")) == [
        None, None, 7, None,
    ]


@pytest.mark.parametrize("to", ["int", "bigint", "double"])
def test_safe_agrees_with_the_plain_cast_on_any_text(spark, to):
    rng = random.Random(5)
    alphabet = "0123456789" * 3 + "+-.,eEdDfFxX nNaAiIyYtT\t\n\u0001\u0085\u00a0\u0663"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 6))) for _ in range(20_000)]
    texts += ["NaN", "nan", "inf", "-inf", "+Infinity", "infinity", "1e3", "12d", "12f", "0x1p3"]
    texts += [" 45 ", "\t7\n", "-.05", "5.", ".", "+", "2147483648", "9223372036854775808"]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    differing = df.where(~F.col("c").try_cast(to).eqNullSafe(safe("c", to)))
    assert differing.collect() == []
    assert df.where(safe("c", to).isNotNull()).count() > 100


def test_safe_timestamp(spark):
    got = evaluate(spark, ["2020-08-01 06:00:00", "bad", None], lambda c: safe(c, "timestamp"))
    assert got == [dt.datetime(2020, 8, 1, 6), None, None]


def test_strict_date_fails_on_bad_text(spark):
    assert evaluate(spark, ["2024-10-29", None], strict_date) == [dt.date(2024, 10, 29), None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        evaluate(spark, ["bad-date"], strict_date)


def test_locale_decimal(spark):
    got = evaluate(spark, ["18,4", "18.4", "-0,5", "Varias", None, "1,2,3"], locale_double)
    assert got == [18.4, 18.4, -0.5, None, None, None]


def test_trace_value_and_three_valued_flag(spark):
    got = evaluate(spark, ["Ip", "1,5", "Acum", None, "0,0"], trace_value, trace_flag)
    assert got == [(0.0, True), (1.5, False), (None, False), (None, None), (0.0, False)]


def test_guard_checks_shape_only(spark):
    texts = ["06:40", "7:05", "Varias", "99:99", "06:40:00", None, "06:40\n"]
    got = evaluate(spark, texts, lambda c: guard(c, HOUR_MINUTE))
    assert got == ["06:40", None, None, "99:99", None, None, "06:40\n"]


def test_label_keeps_na_as_a_code_and_names_the_rest(spark):
    got = evaluate(spark, ["NA", "WP", "XX", None], lambda c: label(c, layouts.BASINS, "?"))
    assert got == ["Atlántico Norte", "Pacífico Oeste (tifones)", "?", "?"]


def test_null_token_is_exact(spark):
    got = evaluate(spark, ["***", "**", " ***", None], lambda c: null_token(c, "***"))
    assert got == [None, "**", " ***", None]


def test_day_bounds(spark):
    df = spark.range(1).select(F.lit("2024-02-29").cast("date").alias("d"))
    got = df.select(day_bound("d"), day_bound("d", end_of_day=True)).first()
    assert tuple(got) == ("2024-02-29T00:00:00UTC", "2024-02-29T23:59:59UTC")


@pytest.mark.parametrize("to", ["double", "int", "bigint"])
def test_skipped_casts_would_have_failed(spark, to):
    cells = ["18,4", "1.5", "Ip", "Acum", "Varias", "NaN", " nan", "inf", "-Infinity", "+1", "-.2", "1e3", "Inf", "I",
             "", " ", "\t5", "5\t", "12abc", "١", "1d", "0x1F", " 7", None]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    got = df.select(safe("c", to).alias("a"), F.when(F.trim("c") != "", F.col("c").try_cast(to)).alias("b")).collect()
    assert all(repr(r["a"]) == repr(r["b"]) for r in got)


def test_label_without_entries(spark):
    assert spark.range(1).select(label(F.lit("x"), {}, "none")).first()[0] == "none"

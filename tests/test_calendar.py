"""Calendar dimension: generation and keep/refresh upsert."""

import datetime as dt

from pyspark.sql import functions as F

from effort_analytics.plans.calendar import (CALENDAR_COLUMNS, _calendar_columns, date_dimension,
                                             generate_calendar, upsert_calendar)

RUN_AT = dt.datetime(2021, 6, 1, 8, 0)


def test_generated_calendar_has_no_gaps_or_repeats(spark):
    cal = generate_calendar(spark, dt.date(2020, 1, 1), dt.date(2022, 1, 1), run_at=RUN_AT)
    days = [r.DateShort for r in cal.orderBy("DateShort").collect()]
    real = [d for d in days if d.year not in (1900, 9999)]
    assert len(real) == 731 and len(set(days)) == len(days)
    assert all((b - a).days == 1 for a, b in zip(real, real[1:]))
    assert days[0] == dt.date(1900, 1, 1) and days[-1] == dt.date(9999, 12, 31)
    row = cal.where(F.col("DateShort") == dt.date(2021, 1, 2)).first()
    assert (row.DateKey, row.DateQuarterName, row.DateDayName, row.IsWeekend, row.DateMonthName) == \
        (20210102, "Q1-2021", "Saturday", 1, "January")


def test_fresh_dimension_starts_at_default_year(spark):
    cal = date_dimension(spark, dt.date(2021, 6, 1), run_at=RUN_AT)
    years = cal.agg(F.min("DateYear"), F.max("DateYear")).first()
    assert cal.columns == CALENDAR_COLUMNS
    assert years[0] == 1900 and years[1] == 9999
    real = cal.where(~F.col("DateYear").isin(1900, 9999)).agg(F.min("DateShort"), F.max("DateShort")).first()
    assert real[0] == dt.date(1955, 1, 1) and real[1] == dt.date(2022, 12, 31)


def _existing(spark, days, holiday_day=None):
    df = spark.createDataFrame([(d,) for d in days], "d date")
    cols = _calendar_columns(F.col("d"), F.lit(dt.datetime(2000, 1, 1)).cast("timestamp"), "OLD")
    out = df.select(*cols).withColumn("DateDayName", F.lit("stale"))
    if holiday_day:
        out = out.withColumn("IsHoliday_PH", F.when(F.col("DateShort") == holiday_day, 1).otherwise(0))
    return out


def test_upsert_keeps_flags_and_refreshes_calendar_columns(spark):
    days = [dt.date(2018, 5, 1), dt.date(2019, 12, 25), dt.date(2020, 3, 3)]
    existing = _existing(spark, days, holiday_day=dt.date(2020, 3, 3))
    out = upsert_calendar(existing, dt.date(2020, 7, 1), run_at=RUN_AT)
    by_day = {r.DateShort: r for r in out.collect()}
    # second-largest year present is 2019 -> generated range 2019-01-01 .. 2021-12-31
    assert min(d for d in by_day if d.year not in (1900, 9999)) == dt.date(2018, 5, 1)
    assert dt.date(2019, 1, 1) in by_day and dt.date(2021, 12, 31) in by_day and dt.date(2022, 1, 1) not in by_day
    kept = by_day[dt.date(2020, 3, 3)]
    assert kept.IsHoliday_PH == 1 and kept.CreatedBy == "OLD" and kept.ModifiedBy != "OLD"
    assert kept.DateDayName == "Tuesday"
    outside = by_day[dt.date(2018, 5, 1)]
    assert outside.DateDayName == "stale" and outside.ModifiedBy == "OLD"
    assert dt.date(1900, 1, 1) in by_day and dt.date(9999, 12, 31) in by_day
    assert out.count() == len(by_day)


def test_upsert_with_sentinels_present_uses_newest_real_year(spark):
    existing = _existing(spark, [dt.date(1900, 1, 1), dt.date(2019, 2, 2), dt.date(9999, 12, 31)])
    out = upsert_calendar(existing, dt.date(2020, 7, 1), run_at=RUN_AT)
    real = out.where(~F.col("DateYear").isin(1900, 9999)).agg(F.min("DateShort")).first()[0]
    assert real == dt.date(2019, 1, 1)
    assert out.where(F.col("DateYear") == 9999).count() == 1

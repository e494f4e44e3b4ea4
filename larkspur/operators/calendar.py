"""Calendar and 4-5-4 retail calendar tables.

These frames have one row per day, so a century is some 36,500 rows; they can
be broadcast to facts of any size. Their column names are fixed values: calendars
already in use have them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions import dates as d
from larkspur.operators.joins import range_join


def date_dimension(days: DataFrame, day: str = "date_day") -> DataFrame:
    """Calendar attributes of each day, with its counterparts one year and 364 days earlier."""
    base = days.select(F.to_date(day).alias("date_day"))
    base = base.withColumn("prior_year_date_day", F.add_months("date_day", -12)).withColumn(
        "prior_year_over_year_date_day", F.date_sub("date_day", 364)
    )
    weeks = {
        "week_start_date": d.week_start, "week_end_date": d.week_end, "week_of_year": d.week_of_year,
        "iso_week_start_date": d.iso_week_start, "iso_week_end_date": d.iso_week_end, "iso_week_of_year": F.weekofyear,
    }
    this_year = [fn("date_day").alias(name) for name, fn in weeks.items()]
    last_year = [fn("prior_year_over_year_date_day").alias(f"prior_year_{name}") for name, fn in weeks.items()]
    return base.select(
        "date_day",
        d.days_away("date_day", -1).alias("prior_date_day"),
        d.days_away("date_day", 1).alias("next_date_day"),
        "prior_year_date_day",
        "prior_year_over_year_date_day",
        d.day_of_week("date_day", iso=False).alias("day_of_week"),
        d.day_of_week("date_day", iso=True).alias("day_of_week_iso"),
        d.day_name("date_day", short=False).alias("day_of_week_name"),
        d.day_name("date_day", short=True).alias("day_of_week_name_short"),
        F.dayofmonth("date_day").alias("day_of_month"),
        F.dayofyear("date_day").alias("day_of_year"),
        *this_year,
        *last_year,
        F.month("date_day").alias("month_of_year"),
        d.month_name("date_day", short=False).alias("month_name"),
        d.month_name("date_day", short=True).alias("month_name_short"),
        d.period_start("date_day", "month").alias("month_start_date"),
        d.period_end("date_day", "month").alias("month_end_date"),
        d.period_start("prior_year_date_day", "month").alias("prior_year_month_start_date"),
        d.period_end("prior_year_date_day", "month").alias("prior_year_month_end_date"),
        F.quarter("date_day").alias("quarter_of_year"),
        d.period_start("date_day", "quarter").alias("quarter_start_date"),
        d.period_end("date_day", "quarter").alias("quarter_end_date"),
        F.year("date_day").alias("year_number"),
        d.period_start("date_day", "year").alias("year_start_date"),
        d.period_end("date_day", "year").alias("year_end_date"),
    )


def fiscal_year_dates(dimension: DataFrame, year_end_month: int = 12, week_start_day: int = 1, shift_year: int = 1) -> DataFrame:
    """Days with their fiscal year and week.

    A year ends with the week whose last day is closest to the end of the given
    month. The first year in the calendar has no known start and drops out.
    ``week_start_day`` counts from Sunday = 1.
    """
    closing = dimension.filter((F.col("month_of_year") == year_end_month) & (F.col("day_of_week") == week_start_day))
    last_day = F.date_add("date_day", 6)
    ends = closing.groupBy("year_number").agg(
        F.min_by(last_day, F.abs(F.date_diff(last_day, "month_end_date"))).alias("fiscal_year_end_date")
    )
    # one row per year
    previous = F.lag("fiscal_year_end_date").over(Window.orderBy("fiscal_year_end_date"))
    years = ends.select(
        (F.col("year_number") - shift_year).alias("fiscal_year_number"),
        F.date_add(previous, 1).alias("fiscal_year_start_date"),
        "fiscal_year_end_date",
    ).filter(F.col("fiscal_year_start_date").isNotNull())
    into_week = F.pmod(F.col("day_of_week") - week_start_day, F.lit(7))
    days = dimension.select("date_day", F.date_sub("date_day", into_week).alias("week_start_date"))
    whole_weeks = days.join(
        dimension.select(F.col("date_day").alias("_first")), F.col("week_start_date") == F.col("_first"), "left_semi"
    )
    placed = range_join(whole_weeks, years, "date_day", "fiscal_year_start_date", "fiscal_year_end_date")
    weeks_in = F.floor(F.date_diff("week_start_date", "fiscal_year_start_date") / 7)
    return placed.select(
        "date_day", "fiscal_year_number", "fiscal_year_start_date", "fiscal_year_end_date", "week_start_date",
        F.date_add("week_start_date", 6).alias("week_end_date"), (weeks_in + 1).cast("int").alias("fiscal_week_of_year"),
    )


# In each 13-week quarter the periods begin after these many weeks.
PERIOD_OFFSETS = (0, 4, 9)
LAST_WEEK = 53


def fiscal_periods(dimension: DataFrame, year_end_month: int = 12, week_start_day: int = 1, shift_year: int = 1) -> DataFrame:
    """The 4-5-4 calendar: week, period and quarter; week 53 joins the last period."""
    days = fiscal_year_dates(dimension, year_end_month, week_start_day, shift_year)
    week = F.col("fiscal_week_of_year")
    quarter = F.least(F.floor((week - 1) / 13), F.lit(3)).cast("int")
    in_quarter = week - 1 - quarter * 13
    _, second, third = PERIOD_OFFSETS
    period = F.when(in_quarter >= third, 3).when(in_quarter >= second, 2).otherwise(1)
    first_week = F.element_at(F.array(*[F.lit(o) for o in PERIOD_OFFSETS]), period)
    return days.select(
        "date_day", "fiscal_year_number", "week_start_date", "week_end_date", "fiscal_week_of_year",
        (in_quarter - first_week + 1).cast("int").alias("fiscal_week_of_period"),
        (quarter * 3 + period).alias("fiscal_period_number"),
        (quarter + 1).alias("fiscal_quarter_number"),
        period.alias("fiscal_period_of_quarter"),
    )

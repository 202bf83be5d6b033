"""Date/time features (F9-F12, D-6, D-7, D-10, D-11).  Session time zone is UTC (D3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import col, ladder, rint0

# ---- fixed values (labels and cut points of the reference's buckets) -------------
TIME_OF_DAY = ["Morning", "Afternoon", "Evening", "Late Night"]
WEEKDAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
TIME_TO_POST = ["Within 15 minutes", "15 to 29 minutes", "30 to 44 minutes",
                "45 minutes to 1 Hour", "1 to 2 Hours", "2 to 4 Hours",
                "4 to 12 Hours", ">12 Hours"]
NO_ARTICLE = "No Article"
# -----------------------------------------------------------------------------------


def as_timestamp(c: str | Column) -> Column:
    """Driver timestamps are ``timestamp_ntz``; interpret them as UTC instants."""
    return col(c).cast("timestamp")


def parse_iso(c: str | Column) -> Column:
    """``ymd_hms(gsub("Z","",gsub("T","",x)))`` — accepts both the ISO form and
    the glued ``yyyy-MM-ddHH:mm:ss`` form; unparsable text -> null (never raises)."""
    x = F.regexp_replace(F.regexp_replace(col(c), "T", ""), "Z", "")
    return F.coalesce(F.try_to_timestamp(x, F.lit("yyyy-MM-ddHH:mm:ss")),
                      F.try_to_timestamp(x, F.lit("yyyy-MM-dd HH:mm:ss")))


def epoch_seconds_ts(c: str | Column) -> Column:
    """epoch seconds -> UTC timestamp."""
    return F.timestamp_seconds(col(c))


def hour_of(ts: str | Column) -> Column:
    return F.hour(col(ts)).cast("long")


def time_of_day(hr: str | Column) -> Column:
    """D-6: [8,12) Morning, [12,18) Afternoon, [18,24) Evening, [0,8) Late Night."""
    h = col(hr)
    return ladder([((h >= 8) & (h < 12), "Morning"),
                   ((h >= 12) & (h < 18), "Afternoon"),
                   ((h >= 18) & (h < 24), "Evening"),
                   ((h >= 0) & (h < 8), "Late Night")])


def weekday_name(ts: str | Column) -> Column:
    """full English weekday name."""
    return F.date_format(col(ts), "EEEE")


def weekend_flag(dow: str | Column, reference_quirk: bool = False) -> Column:
    """D-7 / D1: the reference labels both branches "Weekend"; default is the fix."""
    weekend = F.coalesce(col(dow).isin("Sunday", "Saturday"), F.lit(False))
    return F.lit("Weekend") if reference_quirk else \
        F.when(weekend, "Weekend").otherwise("Weekday")


def minutes_between(later: str | Column, earlier: str | Column) -> Column:
    """``difftime(later, earlier, units="mins")`` as double minutes."""
    return (F.unix_micros(col(later)) - F.unix_micros(col(earlier))) / F.lit(60_000_000.0)


def time_to_post(approve_ts: str | Column, pub_ts: str | Column) -> Column:
    """D-10: rounded (half-even) minutes from publication to approval, clamped at 0."""
    m = rint0(minutes_between(approve_ts, pub_ts))
    return F.when(m < 0, F.lit(0.0)).otherwise(m)


def time_to_post_category(ttp: str | Column, pub_ts: str | Column | None = None,
                          no_article_label: bool = False) -> Column:
    """D-11 ladder.  D2: the reference's "No Article" branch is unreachable (null
    falls out earlier); ``no_article_label=True`` gives the intended label."""
    t = col(ttp)
    pairs = [((t >= 0) & (t < 15), TIME_TO_POST[0]),
             ((t >= 15) & (t < 30), TIME_TO_POST[1]),
             ((t >= 30) & (t < 45), TIME_TO_POST[2]),
             ((t >= 45) & (t <= 60), TIME_TO_POST[3]),
             ((t > 60) & (t <= 120), TIME_TO_POST[4]),
             ((t > 120) & (t <= 240), TIME_TO_POST[5]),
             ((t > 240) & (t <= 720), TIME_TO_POST[6]),
             ((t > 720), TIME_TO_POST[7])]
    if no_article_label and pub_ts is not None:
        pairs.append((col(pub_ts).isNull(), NO_ARTICLE))
    return ladder(pairs)

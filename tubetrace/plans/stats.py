"""The windowed statistics of the engine, as configuration.

Each function takes stage rows and the name of the time column that windows are cut on,
and returns one row per window and key. ``aggregate`` is the batch operator by default;
the streaming jobs pass the streaming one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import union_id
from ..functions.times import (day_of, format_time, hour_label, millis_between, truncated_mean,
                               whole_hours, whole_minutes)
from ..operators.windows import WindowStat, windowed_stats
from ..schemas import STAGES, time_column

# Window sizes.
STAT_WINDOW = "3 minutes"
DELAY_WINDOW = "10 minutes"
PERSON_WINDOW = "1 second"

# the latest receipt is found on the timestamp and written as text afterwards: a string
# in the buffer would make Spark sort the rows instead of hashing them
RECEIVED = "recTs"


def count_rows() -> Column:
    return F.lit(1)


def union_stages(*stats: DataFrame) -> DataFrame:
    """UNION ALL of stage statistics with the same columns."""
    return reduce(DataFrame.unionByName, stats)


def _texts(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: format_time(c) for c in columns})


def _person_collected() -> Column:
    return F.concat("collectTime", "personIdCard")


# --- city and district ---------------------------------------------------------------

CITY_COLUMNS = (
    "window_start", "window_end", "union_id", "area_id", "collect_location_city",
    "collect_location_district", "source", "upload_number", "success_number", "fail_number",
    "tube_number", "problem_number", "problem_error", "problem_unsync", "upload_time", "create_by")
CITY_SUMS = ("success_number", "tube_number", "problem_number", "problem_error", "problem_unsync",
             "upload_number")


def _city_row(stat: DataFrame, source: int) -> DataFrame:
    stat = _texts(stat, "upload_time")
    present = set(stat.columns)
    for name in ("collect_location_city", "collect_location_district"):
        if name not in present:
            stat = stat.withColumn(name, F.lit(""))
    for name in ("upload_number", "success_number", "fail_number", "problem_number",
                 "problem_error", "problem_unsync"):
        if name not in present:
            stat = stat.withColumn(name, F.lit(0).cast("bigint"))
    key = union_id("area_id", "collect_location_city", "collect_location_district",
                   F.lit(source), F.lit(0), day_of("upload_time"))
    return stat.withColumns({"source": F.lit(source), "union_id": key}).select(*CITY_COLUMNS)


_CITY_KEYS = {"collect_location_city": "collectLocationCity",
              "collect_location_district": "collectLocationDistrict"}


def _city_checked(flagged, time, source, distinct, aggregate):
    stat = WindowStat(
        STAT_WINDOW,
        keys={"area_id": F.col("areaId"), **{n: F.col(c) for n, c in _CITY_KEYS.items()}},
        sums={"problem_number": F.col("hasError").cast("int"),
              "problem_error": F.col("hasBadData").cast("int"),
              "problem_unsync": F.col("hasMissingStage").cast("int")},
        distinct={**distinct, "success_number": _person_collected(),
                  "tube_number": F.col("tubeCode")},
        maxima={"upload_time": F.col(RECEIVED), "create_by": F.col("userName")})
    return _city_row(aggregate(flagged, time, stat), source)


def city_collect(flagged: DataFrame, time="recTs", aggregate=windowed_stats) -> DataFrame:
    """Collect records carrying error flags, per area, city and district."""
    return _city_checked(flagged, time, 1, {}, aggregate)


def city_report(flagged: DataFrame, time="recTs", aggregate=windowed_stats) -> DataFrame:
    """Report records carrying error flags and ``isCollected``."""
    matched = F.when(F.col("isCollected"), F.concat_ws("_", "personIdCard", "tubeCode"))
    return _city_checked(flagged, time, 4, {"upload_number": matched}, aggregate)


def _city_tubes(rows, time, source, aggregate):
    stat = WindowStat(STAT_WINDOW, keys={"area_id": F.col("areaId")},
                      sums={"tube_number": F.col("tubeNum")},
                      maxima={"upload_time": F.col(RECEIVED), "create_by": F.col("userName")})
    return _city_row(aggregate(rows, time, stat), source)


def city_transport(rows: DataFrame, time="recTs", aggregate=windowed_stats) -> DataFrame:
    return _city_tubes(rows, time, 2, aggregate)


def city_receive(rows: DataFrame, time="recTs", aggregate=windowed_stats) -> DataFrame:
    return _city_tubes(rows, time, 3, aggregate)


# --- organisation --------------------------------------------------------------------

ORG_COLUMNS = (
    "window_start", "window_end", "union_id", "area_id", "org_name", "collect_location_name",
    "collect_location_district", "source", "upload_number", "success_number", "tube_number",
    "upload_time", "create_by")
ORG_SUMS = ("upload_number", "success_number", "tube_number")

# per stage: organisation, site and district fields, if any
_ORG_FIELDS = {
    "collect": ("collectOrgName", "collectLocationName", "collectLocationDistrict"),
    "transport": ("transportOrgName", "collectAddress", None),
    "receive": ("receiveOrgName", None, None),
    "report": ("checkOrgName", "collectLocationName", "collectLocationDistrict"),
}


def org_stat(rows: DataFrame, stage: str, time="recTs", aggregate=windowed_stats) -> DataFrame:
    """Uploads per organisation and site of one stage."""
    source = STAGES[stage].source
    names = ("org_name", "collect_location_name", "collect_location_district")
    fields = dict(zip(names, _ORG_FIELDS[stage]))
    by_person = stage in ("collect", "report")
    stat = WindowStat(
        STAT_WINDOW,
        keys={"area_id": F.col("areaId"), **{n: F.col(f) for n, f in fields.items() if f}},
        sums={"upload_number": count_rows(),
              **({} if by_person else {"tube_number": F.col("tubeNum")})},
        distinct={"success_number": _person_collected(), "tube_number": F.col("tubeCode")}
        if by_person else {},
        maxima={"upload_time": F.col(RECEIVED), "create_by": F.col("userName")})
    out = _texts(aggregate(rows, time, stat), "upload_time")
    for name, column in fields.items():
        if not column:
            out = out.withColumn(name, F.lit(""))
    if not by_person:
        out = out.withColumn("success_number", F.lit(0).cast("bigint"))
    key = union_id("area_id", "org_name", "collect_location_district", "collect_location_name",
                   F.lit(source), day_of("upload_time"))
    return out.withColumns({"source": F.lit(source), "union_id": key}).select(*ORG_COLUMNS)


# --- reporting delay -----------------------------------------------------------------

DELAY_COLUMNS = ("window_start", "window_end", "union_id", "area_id", "source", "client_id",
                 "data_delay_time", "delay_sum", "delay_count", "create_time")
# Fixed value: the kind of delay written to the sink table.
REPORT_DELAY_LABEL = "上报时间延迟"


def report_delay(rows: DataFrame, stage: str, time="recTs", now: Column | None = None,
                 aggregate=windowed_stats) -> DataFrame:
    """Minutes from the stage's time to ``now`` (default: the row's own time), summed
    per area, client and clock hour."""
    source = STAGES[stage].source
    moment = time_column(STAGES[stage].section_time)
    until = F.col(time) if now is None else now
    stat = WindowStat(
        STAT_WINDOW,
        keys={"area_id": F.col("areaId"), "client_id": F.col("clientId"),
              "data_delay_time": hour_label(time)},
        sums={"delay_sum": whole_minutes(moment, until), "delay_count": count_rows()},
        maxima={"create_time": F.col(RECEIVED)})
    key = union_id("area_id", F.lit(source), "client_id", "data_delay_time")
    return (_texts(aggregate(rows, time, stat), "create_time")
            .withColumns({"source": F.lit(str(source)), "union_id": key}).select(*DELAY_COLUMNS))


# --- stage delay ---------------------------------------------------------------------

def stage_delay(rows: DataFrame, stage: str, time="recTs", day_chars: int = 10,
                aggregate=windowed_stats) -> DataFrame:
    """Mean whole minutes from the stage's time to receipt, per area and 10 minutes.

    ``day_chars=9`` groups by the first nine characters of the receipt time, as older
    reports did.
    """
    spec = STAGES[stage]
    minutes = whole_minutes(time_column(spec.section_time), "recTs")
    stat = WindowStat(
        DELAY_WINDOW,
        keys={"area_id": F.col("areaId"), "_day": F.substring("interfaceRecTime", 1, day_chars)},
        sums={"_minutes": minutes, "_known": minutes.isNotNull().cast("int")},
        maxima={"_stage_time": F.col(time_column(spec.section_time)),
                "create_time": F.col(RECEIVED)})
    out = _texts(aggregate(rows, time, stat), "_stage_time", "create_time")
    return out.select(
        "area_id", F.lit(spec.source).alias("source"), day_of("_stage_time").alias("day_date"),
        F.hour("window_start").alias("unit_hour"), F.minute("window_start").alias("unit_minute"),
        truncated_mean("_minutes", "_known").alias("delay_avg"), "create_time")


# --- persons per hour of day ---------------------------------------------------------

HOUR_COLUMNS = ("window_start", "window_end", "union_id", "area_id", "unit_hour", "source",
                "collect_persons", "check_persons", "collect_all", "check_all", "create_time")
HOUR_SUMS = ("collect_persons", "check_persons", "collect_all", "check_all")


def hour_persons(rows: DataFrame, stage: str, time="recTs", aggregate=windowed_stats) -> DataFrame:
    """Persons collected, or (report, with ``isCollected``) tested, per hour of collection."""
    source = STAGES[stage].source
    collecting = stage == "collect"
    persons, everyone = (("collect_persons", "collect_all") if collecting
                         else ("check_persons", "check_all"))
    person = (F.col("personIdCard") if collecting else
              F.when(F.col("isCollected"), F.concat_ws("_", "personIdCard", "tubeCode")))
    stat = WindowStat(
        PERSON_WINDOW,
        keys={"area_id": F.col("areaId"), "unit_hour": F.hour("collectTs")},
        sums={everyone: count_rows()}, distinct={persons: person},
        maxima={"create_time": F.col(RECEIVED)})
    out = _texts(aggregate(rows, time, stat), "create_time")
    for name in HOUR_SUMS:
        if name not in (persons, everyone):
            out = out.withColumn(name, F.lit(0).cast("bigint"))
    key = union_id("area_id", "unit_hour", day_of("create_time"))
    return out.withColumns({"source": F.lit(source), "union_id": key}).select(*HOUR_COLUMNS)


# --- today ---------------------------------------------------------------------------

TODAY_COLUMNS = ("window_start", "window_end", "union_id", "area_id", "source", "upload_number",
                 "success_number", "fail_number", "upload_time", "create_by", "tube_number",
                 "drop_data_num")
TODAY_SUMS = ("upload_number", "success_number", "fail_number", "tube_number")


def today_stat(rows: DataFrame, stage: str, time="recTs", aggregate=windowed_stats) -> DataFrame:
    """Records, persons and tubes per area. ``fail_number`` holds distinct persons: the
    name is that of the sink column."""
    source = STAGES[stage].source
    by_person = stage in ("collect", "report")
    stat = WindowStat(
        STAT_WINDOW, keys={"area_id": F.col("areaId")},
        sums={"success_number": count_rows(),
              **({} if by_person else {"tube_number": F.col("tubeNum")})},
        distinct={"fail_number": F.col("personIdCard"), "tube_number": F.col("tubeCode")}
        if by_person else {},
        maxima={"upload_time": F.col(RECEIVED), "create_by": F.col("userName"),
                "drop_data_num": F.col("dropDataNum")})
    out = _texts(aggregate(rows, time, stat), "upload_time")
    zero = F.lit(0).cast("bigint")
    if not by_person:
        out = out.withColumn("fail_number", zero)
    out = out.withColumn("upload_number", F.col("fail_number") if stage == "collect" else zero)
    key = union_id("area_id", F.lit(source), day_of("upload_time"))
    return out.withColumns({"source": F.lit(source), "union_id": key}).select(*TODAY_COLUMNS)


def today_stats(stages: dict[str, DataFrame], aggregate, time="recTs") -> DataFrame:
    """``today_stat`` of all the stages by one call of ``aggregate`` on a list of streams."""
    missing, number = F.lit(None).cast("string"), F.lit(None).cast("int")
    rows = [stages[n].withColumns({
        "_source": F.lit(STAGES[n].source),
        **({"_person": F.col("personIdCard"), "_tube": F.col("tubeCode"), "_tubes": number}
           if n in ("collect", "report") else
           {"_person": missing, "_tube": missing, "_tubes": F.col("tubeNum")})})
        for n in STAGES if n in stages]
    stat = WindowStat(
        STAT_WINDOW, keys={"area_id": F.col("areaId"), "source": F.col("_source")},
        sums={"success_number": count_rows(), "_loaded": F.col("_tubes")},
        distinct={"fail_number": F.col("_person"), "_tubes_seen": F.col("_tube")},
        maxima={"upload_time": F.col(RECEIVED), "create_by": F.col("userName"),
                "drop_data_num": F.col("dropDataNum")})
    out = _texts(aggregate(rows, time, stat), "upload_time")
    collect = F.col("source") == STAGES["collect"].source
    return out.withColumns({
        "upload_number": F.when(collect, F.col("fail_number")).otherwise(F.lit(0).cast("bigint")),
        "tube_number": F.col("_loaded") + F.col("_tubes_seen"),
        "union_id": union_id("area_id", "source", day_of("upload_time"))}).select(*TODAY_COLUMNS)


# --- collect to report gap -----------------------------------------------------------

GAP_COLUMNS = ("window_start", "window_end", "union_id", "area_id", "unit_hour", "check_persons",
               "create_time")


def _gap(rows, time, aggregate, extra):
    stat = WindowStat(
        STAT_WINDOW,
        keys={"area_id": F.col("areaId"), "unit_hour": whole_hours("collectTs", "checkTs")},
        sums={"check_persons": F.col("personId").isNotNull().cast("int"), **extra},
        maxima={"create_time": F.col(RECEIVED)})
    key = union_id("area_id", day_of("create_time"), "unit_hour")
    return _texts(aggregate(rows, time, stat), "create_time").withColumn("union_id", key)


def gap_histogram(rows: DataFrame, time="recTs", aggregate=windowed_stats) -> DataFrame:
    """Persons per area and whole hours between collection and check."""
    return _gap(rows, time, aggregate, {}).select(*GAP_COLUMNS)


def latency_stat(rows: DataFrame, processed: str, time="recTs",
                 aggregate=windowed_stats) -> DataFrame:
    """The gap histogram with the milliseconds from a record's time to its processing."""
    extra = {"sum_delay": millis_between("recTs", processed), "total": count_rows()}
    return _gap(rows, time, aggregate, extra).select(*GAP_COLUMNS, "sum_delay", "total")


def mean_latency(total_millis, count) -> Column:
    """Mean seconds with two decimals."""
    return F.round(F.col(total_millis) / 1000.0 / F.col(count), 2)

"""The engine's jobs, composed from operators. All are plain DataFrame functions: the
streaming runner calls the same code per micro-batch or with the streaming aggregate.

A job returns the rows of its sink tables by table name.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import business_key, hash_id, union_id
from ..functions.times import day_of, hour_of, truncated_mean
from ..operators import batch_log as B
from ..operators import envelope as E
from ..operators import issues as I
from ..operators import relations as R
from ..operators.identity import BUSINESS_KEYS, TUBE_SPACES
from ..operators.joins import lookup_join
from ..operators.rules import CATALOGUE
from ..operators.running import FRESH, after_stored, running_accumulate
from ..operators.scan import ordered_scan
from ..operators.windows import windowed_stats
from ..schemas import REPORT, STAGES
from ..session import ensure_checkpoint_dir
from . import stats

CHANGELOG_ORDER = ("window_end", "source")


def stage_frames(messages: DataFrame) -> dict[str, DataFrame]:
    """Typed rows of the four stages, each from a parse of its own."""
    return {name: E.stage_from_messages(messages, stage) for name, stage in STAGES.items()}


def stages_of(parsed: DataFrame) -> dict[str, DataFrame]:
    """Typed rows of the four stages, from messages that are parsed already."""
    return {name: E.stage_rows(parsed, stage) for name, stage in STAGES.items()}


# --- ids and relations -----------------------------------------------------------------

OBJECT = "map<string,variant>"


def _variant(value: Column) -> Column:
    return value.cast("variant")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _changed(members: Column, changes: dict[str, Column]) -> Column:
    """A JSON object with some members set; a null change leaves what is there."""
    given = F.create_map(*[c for name, value in changes.items() for c in (F.lit(name), value)])
    return _let(F.map_filter(given, lambda name, value: value.isNotNull()), lambda new: F.when(
        F.size(new) == 0, members).otherwise(F.map_concat(
            F.map_filter(members, lambda name, _: ~F.map_contains_key(new, name)), new)))


def _text_of(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _member(members: Column, name: str) -> Column:
    return F.try_element_at(members, F.lit(name))


def _tubes(members: Column, name: str) -> Column:
    """A nested array of tubes; null where it is no array of objects."""
    return F.try_variant_get(_member(members, name), "$", f"array<{OBJECT}>")


def _record_key(kind: Column, members: Column) -> Column:
    """Business key of an element; null if it is not complete."""
    key = F.lit(None).cast("string")
    for tag, fields in BUSINESS_KEYS.items():
        key = F.when(kind == tag, business_key(
            *[_text_of(_member(members, f)) for f in fields])).otherwise(key)
    return key


def _hashed(space: Column, key: Column) -> Column:
    return F.when(key.isNotNull(), hash_id(space, key))


SPACE_END = "\u0001"


def _place(space, key: Column) -> Column:
    """Key of the id map: the id space and the key in it."""
    return F.concat(space, F.lit(SPACE_END), key)


def _enriched_element(kind: Column, members: Column, id_of) -> Column:
    """Element with its id, the ids of its tubes and readable result codes."""
    changes = {"id": _variant(id_of(kind, _record_key(kind, members)))}
    for name in E.RESULT_FIELDS:
        code = _text_of(_member(members, name))
        label = E.decode_result(code)
        changes[name] = F.when(kind.isin(*REPORT.types) & (label != code), _variant(label))
    for name, space in TUBE_SPACES.items():
        changes[name] = F.to_variant_object(_each_tube(members, name, lambda tube, code: _changed(
            tube, {"id": _variant(id_of(F.lit(space), code))})))
    return _changed(members, changes)


def _each_tube(members: Column, name: str, made) -> Column:
    """What ``made`` gives for each tube of a nested array and its code."""
    return F.transform(_tubes(members, name),
                       lambda tube: made(tube, _text_of(_member(tube, "tubeCode"))))


def _with_elements(messages: DataFrame) -> DataFrame:
    """Messages with their members and elements, as maps of variants; ``_data`` is null where
    nothing is to be enriched."""
    parsed = E.parse_envelope(messages, keep_raw=True)
    kind = E.routing_type(F.col("type"))
    rows = parsed.select("message_id", "type", "value", kind.alias("_kind"), F.when(
        kind.isin(*BUSINESS_KEYS), F.from_json("value", OBJECT)).alias("_members"))
    data = F.try_variant_get(F.try_element_at("_members", F.lit("data")), "$", f"array<{OBJECT}>")
    # through ``inline``, so that the text is parsed once however often it is used
    return rows.select("message_id", "type", "value", "_kind", F.inline(F.array(F.struct(
        F.col("_members"), data.alias("_data")))))


def message_keys(messages: DataFrame) -> DataFrame:
    """(message_id, place) of every record and tube of the messages that gets an id."""
    kind = F.col("_kind")

    def places(members):
        own = F.array(_place(kind, _record_key(kind, members)))
        tubes = [_each_tube(members, name, lambda _, code: _place(F.lit(space), code))
                 for name, space in TUBE_SPACES.items()]
        return F.concat(own, *[F.coalesce(t, F.array().cast("array<string>")) for t in tubes])

    found = F.explode(F.flatten(F.transform("_data", places)))
    rows = _with_elements(messages).select("message_id", found.alias("place"))
    return rows.filter(F.col("place").isNotNull()).distinct()


def enrich_messages(messages: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Messages with ids on all records and tubes, as JSON again.

    Ids are hashes of business keys, so each message is rewritten where it is: no
    shuffle, no lookup, no regrouping. Or they come from ``ids``, rows (message_id, place, id)
    out of an id map, where not even one pair of keys may share an id.

    Only the ids and the result codes change; every other member, known here or not, stays
    as the producer wrote it, but for numbers, which are written in their shortest form.
    Messages of unknown types pass unchanged, and so does one that repeats a name inside a
    record; of a name that the envelope repeats, the last value stays.
    """
    rows = _with_elements(messages)
    id_of = _hashed
    if ids is not None:
        # as many entries as the message has records and tubes
        own = ids.groupBy("message_id").agg(F.map_from_entries(F.collect_list(
            F.struct("place", "id"))).alias("_ids"))
        rows = rows.join(own, "message_id", "left")
        id_of = lambda space, key: F.try_element_at("_ids", _place(space, key))
    kind = F.col("_kind")
    changed = F.to_variant_object(F.transform("_data", lambda e: _enriched_element(kind, e, id_of)))
    body = F.to_json(_changed(F.col("_members"), {"data": changed}))
    return rows.select("message_id", "type", F.when(F.col("_data").isNotNull(), body)
                       .otherwise(F.col("value")).alias("value"))


def relation_updates(stages: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """What stage rows add to the relation tables: those whose stages are given."""
    return {name: make(*[stages[s] for s in needed])
            for name, (make, needed) in RELATION_STAGES.items() if {*needed} <= {*stages}}


RELATION_STAGES = {"person": (R.person_relation, ("collect", "report")),
                   "tube": (R.tube_relation, ("collect",)),
                   "delivery": (R.delivery_relation, ("transport", "receive"))}
RELATION_KEYS = {"person": R.PERSON_KEY, "tube": R.TUBE_KEY, "delivery": R.DELIVERY_KEY}


def matched_stages(stages: dict[str, DataFrame], relations: dict[str, DataFrame]):
    """Stage rows joined with what the other stages know about them."""
    person, delivery = relations["person"], relations["delivery"]
    transport = R.match_transport_receive(stages["transport"], delivery)
    return {
        "collect": R.match_collect_report(stages["collect"], person),
        "report": R.match_report_collect(stages["report"], person),
        "receive": R.match_receive_transport(stages["receive"], delivery),
        "transport": transport,
        "tube": I.tube_records(R.match_tubes_collect(
            transport.filter(F.col("matchReceiveTime").isNotNull()), relations["tube"])),
    }


# --- data check ------------------------------------------------------------------------

SOURCES = {"collect": 1, "report": 4, "transport": 2, "tube": 2, "receive": 3}
# rules that can hold a day after a record came, though no message has come since; the time
# from which the day counts
ABSENCE = {"collect": "C6", "transport": "TR2", "tube": "TR6", "receive": "V8"}
ABSENCE_SINCE = {"collect": "collectTs", "transport": "deliveryTs", "receive": "receiveTs"}
ABSENCE_RULES = {n: tuple(r for r in CATALOGUE[n] if r.code == c) for n, c in ABSENCE.items()}


def check_records(matched: dict[str, DataFrame], now: Column, secret=None,
                  rules=CATALOGUE) -> DataFrame:
    """Records of all stages that have ``rules``, with those that they fail and pass, and what
    their issue rows need beside that."""
    parts = []
    for name, of_stage in rules.items():
        source = SOURCES[name]
        found = I.judged(matched[name], of_stage, now, secret)
        parts.append(I.issue_records(found, source, now))
    out = parts[0]
    for other in parts[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def data_check(matched, now: Column, secret=None, stored=None, reopen=True, hot_keys=True,
               due=None):
    """Validate, follow each issue, count issues per day.

    Also returns ``issue_state``: hand it back as ``stored`` with the next batch, or a function
    that reads it for the records (``record_key``) of the batch. Records are matched and judged
    once; errors and passes are both taken from what is checkpointed then. ``due`` are matched
    records of earlier batches that only the rules on absence judge now.
    """
    ensure_checkpoint_dir(matched["collect"].sparkSession)
    records = check_records(matched, now, secret)
    if due is not None:
        records = records.unionByName(check_records(due, now, secret, ABSENCE_RULES),
                                      allowMissingColumns=True)
    records = records.checkpoint()
    if callable(stored):
        stored = stored(records.select("record_key"))
    emitted, state = I.tracked_issues(I.issue_rows(records, 0), I.issue_rows(records, 1), stored,
                                      reopen, hot_keys)
    person, goods = F.col("source").isin(1, 4), F.col("source").isin(2, 3)
    base = list(I.BASE_ISSUE_COLUMNS)
    return {
        "problem_data_cr": emitted.filter(person).select(
            *base, "person_name", "person_id_card", "collect_time", "check_time"),
        "problem_data_tre": emitted.filter(goods).select(*base, "code", "name", "time"),
        "upload_log_prob": I.issue_daily_counts(emitted),
        "issue_state": state,
    }


# --- per-message log -------------------------------------------------------------------

def report_log(messages: DataFrame, matched, now: Column, secret=None,
               parsed: DataFrame | None = None) -> dict[str, DataFrame]:
    """Upload log and reconciliation rows of every message of the four stages."""
    if parsed is None:
        parsed = E.parse_envelope(messages, *STAGES.values())
    results = []
    for name, stage in STAGES.items():
        flagged = I.error_flags(matched[name], CATALOGUE[name], now, secret)
        rows = B.element_results(flagged, stage)
        if name == "transport":
            rows = _with_tube_errors(rows, matched["tube"], now, secret)
        results.append(rows)
    elements = stats.union_stages(*results)
    heads = E.route_by_type(parsed)
    # one row per message, read by all four tables
    ensure_checkpoint_dir(messages.sparkSession)
    summary = B.message_summary(heads, elements).checkpoint()
    log = B.upload_log(summary, now)
    return {
        "upload_log": B.batch_log(log), "upload_log_fail": B.batch_log_fail(log),
        "upload_report": B.reconcile(summary, now),
        "upload_report_fail": B.reconcile_fail(summary, messages, now),
    }


def _with_tube_errors(rows: DataFrame, tubes: DataFrame, now, secret) -> DataFrame:
    flagged = I.error_flags(tubes, CATALOGUE["tube"], now, secret).filter("hasError")
    bad = flagged.select("message_id", "pos").distinct().withColumn("_bad", F.lit(True))
    joined = rows.join(bad, ["message_id", "pos"], "left")
    return joined.withColumn(
        "failed", F.col("failed") | F.col("_bad").isNotNull()).drop("_bad")


# --- hourly summaries ------------------------------------------------------------------

# message field -> sink column
HOURLY_KEYS = {"areaId": "area_id", "collectDate": "collect_date", "unitHour": "unit_hour"}
HOURLY_SUMS = {
    "collectPersons": "collect_persons", "collectSampleNum": "collect_sample_num",
    "transferPersons": "transfer_persons", "transferSampleNum": "transfer_sample_num",
    "receivePersons": "receive_persons", "receiveSampleNum": "receive_sample_num",
    "checkPersons": "check_persons", "checkSampleNum": "check_sample_num"}


def hourly_rows(messages: DataFrame, now: Column) -> DataFrame:
    """Hourly summary records under their sink column names; rows without a key drop."""
    return _hourly_sink(E.hourly_summary_rows(messages, now))


def hourly_rows_of(parsed: DataFrame, now: Column) -> DataFrame:
    """The same, from messages that are parsed already."""
    return _hourly_sink(E.hourly_rows(parsed, now))


def _hourly_sink(rows: DataFrame) -> DataFrame:
    rows = rows.dropna(subset=["areaId", "collectDate"])
    return rows.select(
        "message_id", "pos", *[F.col(c).alias(n) for c, n in HOURLY_KEYS.items()],
        *[F.coalesce(c, F.lit(0)).alias(n) for c, n in HOURLY_SUMS.items()],
        hash_id("HOUR_SUM_REPORT", business_key(*HOURLY_KEYS)).alias("id"),
        F.col("createBy").alias("create_by"), F.col("createTime").alias("create_time"),
        F.col("updateTime").alias("update_time"), F.col("isDelete").alias("is_delete"))


def hourly_summary(messages: DataFrame, now: Column, order=("message_id", "pos")) -> DataFrame:
    """Changelog of the running hourly sums."""
    return running_accumulate(hourly_rows(messages, now), HOURLY_KEYS.values(), order,
                              sums=HOURLY_SUMS.values(), firsts=["create_time"], hot_keys=True)


# --- windowed jobs ---------------------------------------------------------------------

def with_flags(rows: DataFrame, rules, now: Column, secret=None) -> DataFrame:
    return I.error_flags(rows, rules, now, secret)


def city_windows(collect: DataFrame, transport: DataFrame, receive: DataFrame,
                 report: DataFrame, time="recTs", aggregate=windowed_stats) -> DataFrame:
    """Window rows per city and district; collect and report rows carry their flags."""
    return stats.union_stages(
        stats.city_collect(collect, time, aggregate),
        stats.city_transport(transport, time, aggregate),
        stats.city_receive(receive, time, aggregate),
        stats.city_report(report, time, aggregate))


def _all_stages(stat, stages: dict[str, DataFrame], names=tuple(STAGES), **options) -> DataFrame:
    """One statistic over the stages that are given."""
    return stats.union_stages(*[stat(stages[n], n, **options) for n in names if n in stages])


org_windows = partial(_all_stages, stats.org_stat)
delay_windows = partial(_all_stages, stats.report_delay)
stage_delays = partial(_all_stages, stats.stage_delay)
today_windows = partial(_all_stages, stats.today_stat)
hour_windows = partial(_all_stages, stats.hour_persons, names=("collect", "report"))


def with_org_code(rows: DataFrame, organisations: DataFrame) -> DataFrame:
    dim = organisations.select("org_name", F.col("id").alias("org_code"))
    return lookup_join(rows, dim, ["org_name"], order=["org_code"])


def with_client_name(rows: DataFrame, clients: DataFrame) -> DataFrame:
    dim = clients.select("client_id", F.col("client_name").alias("report_client"))
    joined = lookup_join(rows, dim, ["client_id"], order=["report_client"])
    return joined.withColumn("report_client", F.coalesce("report_client", F.lit("")))


def id_of(table: str) -> Column:
    return hash_id(table, "union_id")


# Sink columns that always hold the same.
CITY_FIXED = {"problem_repeat": 0, "fix_number": 0, "fix_number_report": 0, "upload_result": 1,
              "is_delete": 0}
ORG_FIXED = {"is_delete": 0}
TODAY_FIXED = {"number_report": None, "data_file": None, "upload_all": None, "upload_result": 1,
               "is_delete": 0}
GAP_FIXED = {"is_delete": 0}


def _fixed(rows: DataFrame, table: str, values: dict) -> DataFrame:
    return rows.withColumns({"id": id_of(table), **{n: F.lit(v) for n, v in values.items()}})


def with_hour_columns(rows: DataFrame) -> DataFrame:
    """``check_numbers`` repeats the persons checked; two other counts are always 0."""
    return rows.withColumns({
        "transfer_persons": F.lit(0), "receive_persons": F.lit(0),
        "check_numbers": F.col("check_persons"), "is_delete": F.lit(0)})


def _running(rows: DataFrame, sums, firsts=(), stored: DataFrame | None = None) -> DataFrame:
    """Window rows of a key are bounded by the windows of its day: a plain window does.
    ``stored`` are the rows of an earlier changelog that the sums go on from."""
    order = [c for c in CHANGELOG_ORDER if c in rows.columns]
    rows = after_stored(rows, stored, ["union_id"], [*sums, *firsts])
    out = running_accumulate(rows, ["union_id"], [FRESH, *order], sums=sums, firsts=firsts)
    return out.filter(F.col(FRESH) == 1).drop(FRESH)


def with_collect_credits(rows: DataFrame) -> DataFrame:
    """City rows in which the matched uploads found by the report stage are credited to
    the collect row of the same area, city, district and day (``is_credit``)."""
    increments = ("success_number", "tube_number", "problem_number", "problem_error",
                  "problem_unsync")
    own = F.struct("source", F.lit(False).alias("is_credit"))
    credit = F.struct(F.lit(1).alias("source"), F.lit(True).alias("is_credit"))
    copies = F.when(F.col("source") == 4, F.array(own, credit)).otherwise(F.array(own))
    out = rows.withColumn("_copy", F.explode(copies))
    is_credit, from_report = F.col("_copy.is_credit"), F.col("source") == 4
    key = union_id("area_id", "collect_location_city", "collect_location_district",
                   "_copy.source", F.lit(0), day_of("upload_time"))
    return out.withColumns({
        **{c: F.when(is_credit, F.lit(0)).otherwise(F.col(c)) for c in increments},
        "upload_number": F.when(from_report & ~is_credit, F.lit(0))
        .otherwise(F.col("upload_number")),
        "union_id": key,
        **{c: F.when(~is_credit, F.col(c)) for c in ("upload_time", "create_by")},
        "is_credit": is_credit, "source": F.col("_copy.source")}).drop("_copy")


def city_totals(rows: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Running sums per area, city, district, stage and day, on from the ``stored`` ones. Rows
    without an upload time are credits whose collect row is still to come."""
    lasts = ("upload_time", "create_by")
    rows = after_stored(with_collect_credits(rows), stored, ["union_id"],
                        [*stats.CITY_SUMS, *lasts])
    out = ordered_scan(
        rows, ["union_id"], [FRESH, "window_end", "is_credit"],
        running={f"_r_{c}": F.col(c) for c in stats.CITY_SUMS},
        latest={f"_l_{c}": F.col(c) for c in lasts}).filter(F.col(FRESH) == 1)
    return out.withColumns({
        **{c: F.col(f"_r_{c}") for c in stats.CITY_SUMS},
        **{c: F.col(f"_l_{c}") for c in lasts},
    }).drop(FRESH, *[c for c in out.columns if c.startswith(("_r_", "_l_"))])


def city_changelog(rows: DataFrame) -> DataFrame:
    """Running sums per area, city, district, stage and day.

    A credit row updates the collect row it belongs to: it keeps that row's time and
    user, and shows up only once there is such a row.
    """
    return city_sink(city_totals(rows))


def city_sink(totals: DataFrame) -> DataFrame:
    return _fixed(totals.filter(F.col("upload_time").isNotNull()), "upload_log_city", CITY_FIXED)


def org_changelog(rows: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    return _fixed(_running(rows, stats.ORG_SUMS, stored=stored), "upload_log_org", ORG_FIXED)


def delay_changelog(rows: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Running delay sums and their truncated mean."""
    out = _running(rows, ("delay_sum", "delay_count"), ("create_time",), stored)
    return out.withColumns({
        "delay_num": truncated_mean("delay_sum", "delay_count"),
        "delay_type": F.lit(stats.REPORT_DELAY_LABEL), "id": id_of("data_time_delay")})


def hour_changelog(rows: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    out = _running(rows, stats.HOUR_SUMS, ("create_time",), stored)
    return with_hour_columns(_fixed(out, "upload_log_hour", {}))


def today_changelog(rows: DataFrame) -> DataFrame:
    """Running sums per area, stage and day, and per hour of that day."""
    hourly = rows.withColumns({"_hour": hour_of("upload_time"),
                               "upload_hour_num": F.col("success_number"),
                               "fail_hour_num": F.col("fail_number")})
    by_hour = running_accumulate(hourly, ["union_id", "_hour"], ["window_end"],
                                 sums=("upload_hour_num", "fail_hour_num")).drop("_hour")
    return _fixed(_running(by_hour, stats.TODAY_SUMS), "upload_log_time", TODAY_FIXED)


def gap_changelog(rows: DataFrame) -> DataFrame:
    return _fixed(_running(rows, ("check_persons",), ("create_time",)), "upload_log_checkhour",
                  GAP_FIXED)


def latency_changelog(rows: DataFrame) -> DataFrame:
    out = _running(rows, ("check_persons", "sum_delay", "total"), ("create_time",))
    return out.withColumn("delay_avg", stats.mean_latency("sum_delay", "total"))


# Sink tables and the columns that identify their rows.
SINK_KEYS = {
    "quarantine": ("message_id",), "upload_log": ("id",), "upload_log_fail": ("id",), "upload_report": ("id",),
    "upload_report_fail": ("id",), "problem_data_cr": ("id",), "problem_data_tre": ("id",),
    "upload_log_prob": ("area_id", "source", "upload_time"),
    "hour_sum_report": ("area_id", "collect_date", "unit_hour"),
    "upload_log_city": ("union_id",), "upload_log_org": ("union_id",),
    "data_time_delay": ("union_id",), "upload_log_hour": ("union_id",),
    "upload_log_time": ("union_id",), "upload_log_checkhour": ("union_id",),
    "delay_avg": ("area_id", "source", "day_date", "unit_hour", "unit_minute"),
}
# which row of a key is the last, where one batch may hold several
SINK_ORDER = {
    "upload_log_city": ("window_end", "is_credit"), "upload_log_org": ("window_end",),
    "data_time_delay": ("window_end",), "upload_log_hour": ("window_end", "source"),
    "upload_log_time": ("window_end",), "upload_log_checkhour": ("window_end",),
    # errors of an issue come before the pass that closes it
    "problem_data_cr": ("is_valid",), "problem_data_tre": ("is_valid",),
}

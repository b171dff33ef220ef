"""Validation results: candidates, issue rows, their lifecycle and daily counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import hash_id, union_id
from ..functions.predicates import is_blank
from ..functions.times import day_of, format_time
from ..session import ensure_checkpoint_dir
from .rules import BAD_DATA, CATALOGUE, MISSING_STAGE, TUBE_RULES, with_plain_text
from .running import running_accumulate
from .scan import CHUNK, ordered_scan, range_chunks

def validate(df: DataFrame, rules, now: Column, secret=None, only: int | None = None) -> DataFrame:
    """One row per record and rule with an outcome: ``is_valid`` 0 (error) or 1.

    ``only`` keeps one kind of outcome. Only numbers are exploded; what a rule is called is
    looked up by its place, so a row that is not kept costs next to nothing.
    """
    rules = list(rules)
    outcomes = F.array(*[r.outcome(now) for r in rules])
    rows = with_plain_text(df, secret).select(
        *df.columns, F.posexplode(outcomes).alias("_rule", "is_valid"))
    rows = rows.filter(F.col("is_valid").isNotNull() if only is None
                       else F.col("is_valid") == only)

    def of_rule(*values) -> Column:
        return F.array(*map(F.lit, values))[F.col("_rule")]

    return rows.select(
        *df.columns, of_rule(*[r.code for r in rules]).alias("rule_code"),
        of_rule(*[r.problem_type for r in rules]).alias("problem_type"),
        of_rule(*[r.kind for r in rules]).alias("issue_kind"), "is_valid")


# every rule has a bit, so the outcomes of a record are two numbers
ALL_RULES = [r for rules in CATALOGUE.values() for r in rules]
BIT = {r.code: k for k, r in enumerate(ALL_RULES)}


def _bits(rules, value: int) -> Column:
    """The bits of the rules whose outcome column holds ``value``."""
    out = F.lit(0).cast("bigint")
    for r in rules:
        out = out.bitwiseOR(F.when(F.col(f"_o_{r.code}") == value, F.lit(1 << BIT[r.code]))
                            .otherwise(F.lit(0)).cast("bigint"))
    return out


def judged_alone(df: DataFrame, rules, now: Column, secret=None) -> DataFrame:
    """Records ahead of their match, with the bits of the rules that do not look at it: a match
    then moves two numbers instead of the texts and times that these rules look at."""
    alone = [r for r in rules if not r.matched]
    outcomes = with_plain_text(df, secret).select(
        *df.columns, *[r.outcome_alone(now).alias(f"_o_{r.code}") for r in alone])
    return outcomes.select(*df.columns, _bits(alone, 0).alias("failed_rules"),
                           _bits(alone, 1).alias("passed_rules"))


def judged(df: DataFrame, rules, now: Column, secret=None) -> DataFrame:
    """Records with the bits of the rules they fail (``failed_rules``) and of those they pass
    (``passed_rules``): every rule runs once per record, whichever outcome is asked for. Rules
    that ran ahead of the match (``judged_alone``) do not run again."""
    rules = list(rules)
    known = {"failed_rules", "passed_rules"} <= set(df.columns)
    rest = [r for r in rules if r.matched] if known else rules
    columns = [c for c in df.columns if not (known and c in OUTCOMES)]
    outcomes = with_plain_text(df, secret).select(
        *df.columns, *[r.outcome(now).alias(f"_o_{r.code}") for r in rest])
    failed, passed = _bits(rest, 0), _bits(rest, 1)
    if known:
        says = F.lit(~sum(1 << BIT[r.code] for r in rules if r.given)).cast("bigint")
        for r in rules:
            if r.given:
                says = says.bitwiseOR(F.when(r.given(now), F.lit(1 << BIT[r.code]))
                                      .otherwise(F.lit(0)).cast("bigint"))
        failed = failed.bitwiseOR(F.col("failed_rules").bitwiseAND(says))
        passed = passed.bitwiseOR(F.col("passed_rules").bitwiseAND(says))
    places = [BIT[r.code] for r in rules]
    return outcomes.select(
        *columns, failed.alias("failed_rules"), passed.alias("passed_rules"),
        F.lit(min(places)).alias("first_rule"), F.lit(max(places)).alias("last_rule"))


def error_flags(df: DataFrame, rules, now: Column, secret=None) -> DataFrame:
    """Per record: does any rule fail, by kind and by the first two problem types."""
    plain = with_plain_text(df, secret)
    outcomes = plain.withColumns({f"_o_{r.code}": r.outcome(now) == 0 for r in rules})

    def any_of(chosen) -> Column:
        cond = F.lit(False)
        for r in chosen:
            cond = cond | F.coalesce(F.col(f"_o_{r.code}"), F.lit(False))
        return cond

    return outcomes.select(
        *df.columns,
        any_of(rules).alias("hasError"),
        any_of([r for r in rules if r.kind == BAD_DATA]).alias("hasBadData"),
        any_of([r for r in rules if r.kind == MISSING_STAGE]).alias("hasMissingStage"),
        any_of([r for r in rules if r.problem_type == "1"]).alias("hasIdError"),
        any_of([r for r in rules if r.problem_type == "2"]).alias("hasNameError"))


def validation_summary(flagged: DataFrame, groups) -> DataFrame:
    """Per group: records with any error, with bad data, with a missing stage."""
    return flagged.groupBy(*groups).agg(
        F.count_if("hasError").alias("problem_number"),
        F.count_if("hasBadData").alias("problem_error"),
        F.count_if("hasMissingStage").alias("problem_unsync"))


def tube_records(tubes: DataFrame) -> DataFrame:
    """Tubes the tube rules apply to: those of deliveries that were received."""
    return tubes.filter(~is_blank("matchReceiveTime"))


def validate_tubes(tubes: DataFrame, now: Column, secret=None, only=None) -> DataFrame:
    return validate(tube_records(tubes), TUBE_RULES, now, secret, only)


# fields of a stage record that go into its issue rows
_PERSON_FIELDS = {"person_name": "personName", "person_id_card": "personIdCard",
                  "collect_time": "collectTime", "check_time": "checkTime"}
_DELIVERY_FIELDS = {
    2: {"name": "deliveryName", "code": "deliveryCode", "time": "deliveryTime"},
    3: {"name": "receiveName", "code": "receiveCode", "time": "receiveTime"},
}
BASE_ISSUE_COLUMNS = (
    "id", "add_time", "area_id", "source", "submit_id", "number_report", "TYPE", "problem_type",
    "problem_record", "is_delete", "is_valid", "create_by", "create_time", "update_by",
    "update_time", "remark")


def _record_key(source: int) -> Column:
    """What identifies the record of an issue over time."""
    if source in (1, 4):
        moment = "collectTime" if source == 1 else "checkTime"
        parts = ["personIdCard", moment]
    else:
        parts = ["submitId", _DELIVERY_FIELDS[source]["code"]]
    return union_id(F.lit(source), *parts)


OUTCOMES = ("failed_rules", "passed_rules", "first_rule", "last_rule")
PLACE = ("recTs", "message_id", "pos", "itemPos")


def _issue_columns(records: DataFrame, source: int, now: Column) -> list[Column]:
    """What the issue rows of a record have in common, whatever the rule."""
    stamp = format_time(now)
    cols = records.columns
    detail = _PERSON_FIELDS if source in (1, 4) else _DELIVERY_FIELDS[source]
    add_time = F.when(is_blank("addTime") | (F.lower("addTime") == "null"), stamp).otherwise(
        F.col("addTime"))
    tube = F.col("tubeCode") if "itemPos" in cols else F.lit(None).cast("string")
    return [
        _record_key(source).alias("record_key"), tube.alias("_tube"),
        add_time.alias("add_time"), F.col("areaId").alias("area_id"),
        F.lit(source).alias("source"), F.col("submitId").alias("submit_id"),
        F.col("numberReport").alias("number_report"), F.lit(0).alias("is_delete"),
        F.col("userName").alias("create_by"), stamp.alias("create_time"),
        F.col("userName").alias("update_by"), stamp.alias("update_time"),
        F.lit(None).cast("string").alias("remark"),
        *[(F.col(f) if f in cols else F.lit(None).cast("string")).alias(n)
          for n, f in detail.items()],
        *[c for c in PLACE if c in cols]]


def _with_issue_ids(rows: DataFrame) -> DataFrame:
    if "record_key" not in rows.columns:
        return rows
    key = union_id("record_key", "problem_record", "_tube")
    place = [c for c in PLACE if c in rows.columns]
    return rows.withColumn("issue_key", key).withColumn(
        "id", hash_id("ISSUE", union_id("issue_key", *place))).drop("_tube")


def issue_events(candidates: DataFrame, source: int, now: Column) -> DataFrame:
    """Issue rows of a stage's candidates, with their key and place in time."""
    return _with_issue_ids(candidates.select(
        *_issue_columns(candidates, source, now), F.col("issue_kind").alias("TYPE"),
        "problem_type", F.col("rule_code").alias("problem_record"), "is_valid"))


def issue_records(records: DataFrame, source: int, now: Column) -> DataFrame:
    """Judged records of a stage, reduced to what their issue rows need."""
    return records.select(*_issue_columns(records, source, now), *OUTCOMES)


def issue_rows(records: DataFrame, is_valid: int | None = None) -> DataFrame:
    """Issue rows of one outcome, or of both, out of the records of all stages; without ids
    where the records have been cut down to columns that do not tell them apart."""
    failed, passed = F.col("failed_rules"), F.col("passed_rules")
    outcome = failed.bitwiseOR(passed) if is_valid is None else passed if is_valid else failed
    rule = F.col("_rule")

    def has(bits: Column) -> Column:
        return F.call_function("shiftright", bits, rule).bitwiseAND(F.lit(1)) == 1

    rows = records.filter(outcome != 0).select("*", F.explode(
        F.sequence("first_rule", "last_rule")).alias("_rule"))
    rows = rows.filter(has(outcome))

    def of_rule(*values) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), rule + 1)

    rows = rows.withColumns({
        "problem_record": of_rule(*[r.code for r in ALL_RULES]),
        "problem_type": of_rule(*[r.problem_type for r in ALL_RULES]),
        "TYPE": of_rule(*[r.kind for r in ALL_RULES]),
        "is_valid": F.when(has(failed), 0).otherwise(1) if is_valid is None
        else F.lit(is_valid)})
    return _with_issue_ids(rows.drop("_rule", *OUTCOMES))


def issue_lifecycle(candidates: DataFrame, key, order, is_error: Column, opened_at,
                    new_id=None, reopen: bool = True, hot_keys: bool = True,
                    chunks: int | None = None) -> DataFrame:
    """Follow each issue from its first error to its resolution.

    Errors are always kept; a pass is kept only while the issue is open, and closes it.
    Adds ``issue_number`` (how many times the key has opened so far), ``issue_open`` (is
    it open after this row) and ``issue_add_time``, taken from the row that opened the
    issue; with ``new_id`` also ``issue_id``. With ``reopen=False`` a closed issue stays closed: later errors are
    kept under an issue of their own.
    """
    key, order = list(key), list(order)
    rows = candidates.withColumn("_error", F.coalesce(is_error, F.lit(False)))
    if hot_keys:
        rows = range_chunks(rows, key, order, chunks)
    if reopen:
        rows = ordered_scan(rows, key, order, previous={"_before": F.col("_error")})
        rows = rows.withColumn("_open", F.coalesce("_before", F.lit(False)))
        starts = F.col("_error") & ~F.col("_open")
        rows = rows.withColumn("issue_open", F.col("_error"))
    else:
        rows = ordered_scan(rows, key, order, running={"_errors": F.col("_error").cast("int")})
        rows = rows.withColumn("_seen", F.col("_errors") > F.col("_error").cast("int"))
        closing = ~F.col("_error") & F.col("_seen")
        rows = ordered_scan(rows, key, order, running={"_closings": closing.cast("int")})
        rows = rows.withColumn(
            "_open", F.col("_seen") & (F.col("_closings") == closing.cast("int")))
        starts = F.col("_error") & ~F.col("_open")
        rows = rows.withColumn("issue_open", F.col("_error") & (F.col("_closings") == 0))
    opener = {"issue_add_time": F.when(F.col("_start"), F.col(opened_at))}
    if new_id:
        opener["issue_id"] = F.when(F.col("_start"), F.col(new_id))
    rows = ordered_scan(rows.withColumn("_start", starts), key, order,
                        running={"issue_number": F.col("_start").cast("int")}, latest=opener)
    kept = rows.filter(F.col("_error") | F.col("_open"))
    return kept.drop("_error", "_before", "_open", "_start", "_errors", "_seen", "_closings",
                     CHUNK)


def tracked_issues(failed: DataFrame, passed: DataFrame, stored: DataFrame | None = None,
                   reopen: bool = True, hot_keys: bool = True) -> tuple[DataFrame, DataFrame]:
    """Issue rows to emit and the new state of the issue store.

    ``failed`` and ``passed`` are the issue rows of errors and passes. ``stored`` holds
    one row per known key (``issue_key, record_key, id, add_time, is_open``). Each is replayed
    as an earlier candidate, so a batch continues where the last one ended.

    Most passes concern keys that never had an error; they are dropped before anything
    is ordered. The rest is checkpointed, for it is read several times.
    """
    ensure_checkpoint_dir(failed.sparkSession)
    order = [c for c in PLACE if c in failed.columns]
    keys = failed.select("issue_key")
    if stored is not None:
        keys = keys.unionByName(stored.filter("is_open").select("issue_key"))
    passed = passed.join(keys.distinct(), "issue_key", "left_semi")
    rows = failed.unionByName(passed).withColumns({"_stored": F.lit(False), "_step": F.lit(2)})
    rows = rows.checkpoint()
    if stored is not None:
        past = stored.join(rows.select("issue_key").distinct(), "issue_key", "left_semi")
        opened = past.select("issue_key", "record_key", "id", "add_time", F.lit(0).alias("is_valid"),
                             F.lit(True).alias("_stored"), F.lit(0).alias("_step"))
        closed = past.filter(~F.col("is_open")).select(
            "issue_key", "record_key", "id", "add_time", F.lit(1).alias("is_valid"),
            F.lit(True).alias("_stored"), F.lit(1).alias("_step"))
        rows = rows.unionByName(opened.unionByName(closed), allowMissingColumns=True)
    followed = issue_lifecycle(rows, ["issue_key"], ["_step", *order], F.col("is_valid") == 0,
                               "add_time", new_id="id", reopen=reopen, hot_keys=hot_keys)
    state = followed.groupBy("issue_key", "record_key").agg(
        F.max_by(F.struct(F.col("issue_id").alias("id"), F.col("issue_add_time").alias("add_time"),
                          F.col("issue_open").alias("is_open")),
                 F.struct("_step", *order)).alias("_s")).select("issue_key", "record_key", "_s.*")
    emitted = (followed.filter(~F.col("_stored"))
               .withColumns({"id": F.col("issue_id"), "add_time": F.col("issue_add_time")})
               .drop("_stored", "_step", "issue_id", "issue_add_time", "issue_open"))
    return emitted, state


def daily_counters() -> dict[str, Column]:
    """The sixteen counters of an issue row. Which stage, problem type
    and validity each of them counts."""
    bad = F.col("is_valid") == 0
    kind, stage = F.col("problem_type"), F.col("source")

    def of(source: int, problem_type: str) -> Column:
        return bad & (stage == source) & (kind == problem_type)

    return {
        "upload_number": F.lit(True),
        "success_number": F.col("is_valid") == 1,
        "fail_number": of(1, "4"),
        "fail_end_number": of(4, "5"),
        "error_number": bad & (kind <= "4"),
        "cid_number": of(1, "1"),
        "cname_number": of(1, "2"),
        "cphone_number": of(1, "3"),
        "rid_number": of(4, "1"),
        "rname_number": of(4, "2"),
        "rphone_number": of(4, "3"),
        "time_number": bad & (kind == "6"),
        "tr_id_number": of(3, "1"),
        "tr_phone_number": of(3, "2"),
        "re_id_number": of(3, "3"),
        "re_phone_number": of(3, "4"),
    }


COUNTER_KEYS = ("area_id", "source", "upload_time")


def counter_rows(issues: DataFrame) -> DataFrame:
    """Issue rows as counter increments per area, stage and day; rows without a key drop."""
    complete = issues.filter(F.col("area_id").isNotNull() & F.col("source").isNotNull()
                             & ~is_blank("create_time"))
    day = F.concat(day_of("create_time"), F.lit(" 00:00:00"))
    return complete.withColumns({
        "upload_time": day,
        **{n: F.coalesce(c, F.lit(False)).cast("int") for n, c in daily_counters().items()}})


def issue_daily_counts(issues: DataFrame) -> DataFrame:
    """Final counters per area, stage and day."""
    return added_counts(counter_rows(issues))


def added_counts(counts: DataFrame) -> DataFrame:
    """Counters of increments, or of parts that are counted already, added up."""
    return counts.groupBy(*COUNTER_KEYS).agg(*[F.sum(n).alias(n) for n in daily_counters()])


def issue_daily_changelog(issues: DataFrame, order, chunks: int | None = None) -> DataFrame:
    """One row per issue row with the counters so far: what a primary-key sink receives."""
    return running_accumulate(counter_rows(issues), COUNTER_KEYS, order,
                              sums=tuple(daily_counters()), hot_keys=True, chunks=chunks)


"""Catalogue of validation rules.

A rule looks at one record (already matched with the other stages) and yields 0 for an
error, 1 for a pass and null for "nothing to say". Rules are plain column expressions;
a whole catalogue runs in one projection. ``now`` is a parameter, so results can be
repeated.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.crypto import CipherKey, decrypt
from ..functions.predicates import has_special_character, is_blank, is_id_card, is_mobile
from ..functions.times import seconds_between

DAY = 24 * 3600
BAD_DATA, MISSING_STAGE = 2, 1


@dataclass(frozen=True)
class Rule:
    """``error`` and ``passed`` are conditions on the record; ``passed`` defaults to
    "no error". Problem types and kinds are fixed values.

    ``matched`` rules look at what a match adds to the record; ``given`` is the condition on
    the match without which a rule on the record alone has nothing to say."""

    code: str
    problem_type: str
    kind: int
    text: str
    error: Callable[[Column], Column]
    passed: Callable[[Column], Column] | None = None
    matched: bool = False
    given: Callable[[Column], Column] | None = None

    def outcome(self, now: Column) -> Column:
        alone = self.outcome_alone(now)
        return alone if self.given is None else F.when(self.given(now), alone)

    def outcome_alone(self, now: Column) -> Column:
        """The outcome if what it is ``given`` holds."""
        failed = F.coalesce(self.error(now), F.lit(False))
        passed = F.lit(True) if self.passed is None else F.coalesce(self.passed(now), F.lit(False))
        return F.when(failed, 0).when(passed, 1)


def plain(column: str) -> Column:
    """Clear text of a sensitive column (see ``with_plain_text``)."""
    return F.col(f"_plain_{column}")


SENSITIVE = ("personIdCard", "personName", "personPhone", "deliveryPrpId", "deliveryPrpPhone",
             "transportPrpId", "transportPrpPhone")


def with_plain_text(df: DataFrame, secret: CipherKey | None) -> DataFrame:
    """Clear text beside the sensitive columns, decrypted once for all rules."""
    present = [c for c in SENSITIVE if c in df.columns]
    return df.withColumns({
        f"_plain_{c}": F.col(c) if secret is None else decrypt(c, secret) for c in present})


def _before(a: str, b: str) -> Column:
    # zero-padded time strings compare like times
    return F.col(a) < F.col(b)


def _given_before(a: str, b: str) -> Column:
    return ~is_blank(a) & _before(a, b)


def _closer_than(start: str, end: str, minutes: int) -> Callable:
    return lambda now: seconds_between(start, end) < minutes * 60


def _older_than_a_day(ts: str, now: Column) -> Column:
    return seconds_between(F.col(ts), now) >= DAY


def _no_samples(now: Column) -> Column:
    return (F.coalesce("collectCount", F.lit(0)) == 0) | (
        F.coalesce("collectLimitnum", F.lit(0)) == 0)


def _late_result(now: Column) -> Column:
    return _older_than_a_day("collectTs", now) & (
        is_blank("matchCheckTime") | (seconds_between("collectTs", "matchCheckTs") > DAY))


COLLECT_RULES = (
    Rule("C1", "1", BAD_DATA, "identity number with special characters",
         lambda now: has_special_character(plain("personIdCard"))),
    Rule("C2", "3", BAD_DATA, "phone with special characters",
         lambda now: has_special_character(plain("personPhone"))),
    Rule("C3", "7", BAD_DATA, "sample count or limit missing or zero", _no_samples),
    Rule("C4", "2", BAD_DATA, "name with special characters",
         lambda now: has_special_character(plain("personName"))),
    Rule("C5", "6", BAD_DATA, "uploaded before collected",
         lambda now: _before("addTime", "collectTime")),
    Rule("C6", "4", MISSING_STAGE, "no result within a day of collection", _late_result,
         lambda now: _older_than_a_day("collectTs", now), matched=True),
)

_matched_collect = lambda now: ~is_blank("matchCollectTime")

REPORT_RULES = (
    Rule("R1", "1", BAD_DATA, "identity number malformed",
         lambda now: has_special_character(plain("personIdCard"))
         | ~is_id_card(plain("personIdCard"))),
    Rule("R2", "3", BAD_DATA, "phone malformed",
         lambda now: has_special_character(plain("personPhone"))
         | ~is_mobile(plain("personPhone"))),
    Rule("R3", "2", BAD_DATA, "name with special characters",
         lambda now: has_special_character(plain("personName"))),
    Rule("R4", "6", BAD_DATA, "packed before collected",
         lambda now: _given_before("packTime", "collectTime")),
    Rule("R5", "6", BAD_DATA, "received before collected",
         lambda now: _given_before("receiveTime", "collectTime")),
    Rule("R6", "6", BAD_DATA, "checked before collected",
         lambda now: _given_before("checkTime", "collectTime")),
    Rule("R7", "6", BAD_DATA, "checked within 60 minutes of collection",
         _closer_than("collectTs", "checkTs", 60)),
    Rule("R8", "6", BAD_DATA, "packed within 2 minutes of collection",
         _closer_than("collectTs", "packTs", 2)),
    Rule("R9", "6", BAD_DATA, "checked within 20 minutes of receipt",
         _closer_than("receiveTs", "checkTs", 20)),
    Rule("R10", "6", BAD_DATA, "checked before packed",
         lambda now: _before("checkTime", "packTime")),
    Rule("R11", "6", BAD_DATA, "uploaded before checked",
         lambda now: _before("addTime", "checkTime")),
    Rule("R12", "6", BAD_DATA, "checked before received",
         lambda now: _before("checkTime", "receiveTime")),
    Rule("R13", "7", BAD_DATA, "sample count or limit missing or zero", _no_samples),
    Rule("R14", "5", MISSING_STAGE, "no collect record",
         lambda now: is_blank("matchCollectTime"), matched=True),
    Rule("R15", "6", BAD_DATA, "collected after checked",
         lambda now: F.col("collectTime") > F.col("checkTime"), given=_matched_collect),
    Rule("R16", "6", BAD_DATA, "checked more than a day after collection",
         lambda now: seconds_between("collectTs", "checkTs") > DAY, given=_matched_collect),
)


def _full_transport(now: Column) -> Column:
    return (~is_blank("matchDeliveryTime") & F.col("matchTubeNum").isNotNull()
            & F.col("matchPackNum").isNotNull())


def _count_differs(own: str, other: str) -> Callable:
    return lambda now: _full_transport(now) & ~F.col(own).eqNullSafe(F.col(other))


RECEIVE_RULES = (
    Rule("V1", "1", BAD_DATA, "deliverer identity number malformed",
         lambda now: ~is_id_card(plain("deliveryPrpId"))),
    Rule("V2", "2", BAD_DATA, "deliverer phone malformed",
         lambda now: ~is_mobile(plain("deliveryPrpPhone"))),
    Rule("V3", "4", BAD_DATA, "carrier phone malformed",
         lambda now: ~is_mobile(plain("transportPrpPhone"))),
    Rule("V4", "3", BAD_DATA, "carrier identity number malformed",
         lambda now: ~is_id_card(plain("transportPrpId"))),
    Rule("V5", "5", BAD_DATA, "tube count differs from the transport record",
         _count_differs("tubeNum", "matchTubeNum"), _full_transport, matched=True),
    Rule("V6", "5", BAD_DATA, "pack count differs from the transport record",
         _count_differs("packNum", "matchPackNum"), _full_transport, matched=True),
    Rule("V7", "6", BAD_DATA, "received more than a day after delivery",
         lambda now: _full_transport(now) & (seconds_between(F.col("matchDeliveryTs"), now) > DAY)
         & (seconds_between("matchDeliveryTs", "receiveTs") > DAY), _full_transport,
         matched=True),
    Rule("V8", "8", MISSING_STAGE, "no transport record",
         lambda now: is_blank("matchDeliveryTime") & _older_than_a_day("receiveTs", now),
         _full_transport, matched=True),
)

_received = lambda now: ~is_blank("matchReceiveTime")

TRANSPORT_RULES = (
    Rule("TR1", "6", BAD_DATA, "delivered before packed",
         lambda now: _before("deliveryTime", "packTime")),
    Rule("TR2", "7", MISSING_STAGE, "not received within a day",
         lambda now: F.when(is_blank("matchReceiveTime"), _older_than_a_day("deliveryTs", now))
         .otherwise(seconds_between("deliveryTs", "matchReceiveTs") > DAY), _received,
         matched=True),
)


def _tube_found(now: Column) -> Column:
    return ~is_blank("tubeCollectTime") & ~is_blank("collectSubmitId")


def _tube_rule(condition: Callable) -> Callable:
    return lambda now: _tube_found(now) & condition(now)


# per transported tube, for deliveries that were received
TUBE_RULES = (
    Rule("TR3", "6", BAD_DATA, "packed before the tube was collected",
         _tube_rule(lambda now: _before("packTime", "tubeCollectTime")), _tube_found,
         matched=True),
    Rule("TR4", "6", BAD_DATA, "delivered before the tube was collected",
         _tube_rule(lambda now: _before("deliveryTime", "tubeCollectTime")), _tube_found,
         matched=True),
    Rule("TR5", "6", BAD_DATA, "delivered more than a day after the tube was collected",
         _tube_rule(lambda now: seconds_between("tubeCollectTs", "deliveryTs") > DAY),
         _tube_found, matched=True),
    Rule("TR6", "9", MISSING_STAGE, "tube without a collect record",
         lambda now: ~_tube_found(now) & _older_than_a_day("deliveryTs", now),
         lambda now: _tube_found(now) & ~_older_than_a_day("deliveryTs", now), matched=True),
)

CATALOGUE = {"collect": COLLECT_RULES, "transport": TRANSPORT_RULES, "tube": TUBE_RULES,
             "receive": RECEIVE_RULES, "report": REPORT_RULES}

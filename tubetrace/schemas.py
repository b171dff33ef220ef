"""Record layouts of the message envelope and of its element types.

Producers quote numbers inconsistently, so every scalar is read as a string and cast
afterwards (``try_cast``): a bad value becomes null and never fails the job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Envelope field names.
ENVELOPE_FIELDS = {
    "userName": "string",
    "type": "string",
    "clientId": "bigint",
    "numberReport": "bigint",
    "interfaceRecTime": "string",
    "dropDataNum": "int",
}

# Element field names and types per message kind.
COLLECT_FIELDS = """
id bigint, submitId bigint, areaId bigint, recordId bigint, personIdCard string,
personIdCardType string, personName string, personPhone string,
collectLocationName string, collectLocationProvince string, collectLocationCity string,
collectLocationDistrict string, collectLocationStreet string, collectOrgName string,
personId string, collectTypeId int, collectPartId int, tubeCode string,
collectUser string, collectTime string, addTime string, collectCount int,
collectLimitnum int
"""
TRANSPORT_FIELDS = """
id bigint, submitId bigint, areaId bigint, deliveryCode string, deliveryName string,
deliveryTime string, packTime string, collectAddress string, deliveryStatus int,
deliveryOrgName string, deliveryPrp string, transportOrgName string, transportPrp string,
receiveOrgName string, receiveOrgType int, receivePrp string, addTime string, tubeNum int,
packNum int, transportItem items
"""
RECEIVE_FIELDS = """
id bigint, submitId bigint, areaId bigint, receiveCode string, receiveName string,
receiveTime string, deliveryCode string, deliveryOrgName string, deliveryPrp string,
deliveryPrpId string, deliveryPrpPhone string, transportOrgName string,
transportPrp string, transportPrpId string, transportPrpPhone string,
receiveOrgName string, receiveOrgType int, receivePrp string, addTime string, tubeNum int,
packNum int, receivesItem items
"""
REPORT_FIELDS = """
id bigint, submitId bigint, areaId bigint, recordId bigint, personIdCard string,
personIdCardType string, personName string, personPhone string,
collectLocationName string, collectLocationProvince string, collectLocationCity string,
collectLocationDistrict string, collectLocationStreet string, collectTypeId int,
collectPartId int, tubeCode string, collectUser string, collectTime string,
packTime string, deliveryCode string, collectOrgName string, checkOrgName string,
receiveTime string, receiveUser string, personId string, checkTime string,
checkUser string, checkResult string, iggResult string, igmResult string, remark string,
addTime string, collectLimitnum int, collectCount int
"""
HOURLY_FIELDS = """
areaId bigint, id bigint, collectDate string, unitHour int, collectPersons int,
collectSampleNum int, transferPersons int, transferSampleNum int, receivePersons int,
receiveSampleNum int, checkPersons int, checkSampleNum int
"""
CHECK_ORG_FIELDS = "creditCode string, areaId bigint, orgName string"


def _fields(text: str) -> dict[str, str]:
    pairs = (part.split() for part in text.replace("\n", " ").split(","))
    return {name: kind for name, kind in pairs}


@dataclass(frozen=True)
class Stage:
    """One message kind: its number, type tags, fields and the times it carries."""

    name: str
    source: int | None
    types: tuple[str, ...]
    fields: dict[str, str]
    section_time: str | None = None
    times: tuple[str, ...] = ()
    items: str | None = None


# Stage numbers and message type tags.
COLLECT = Stage("collect", 1, ("COLLECT_DATA",), _fields(COLLECT_FIELDS),
                "collectTime", ("collectTime",))
TRANSPORT = Stage("transport", 2, ("TRANSPORT_DATA",), _fields(TRANSPORT_FIELDS),
                  "deliveryTime", ("deliveryTime",), "transportItem")
RECEIVE = Stage("receive", 3, ("RECEIVE_DATA",), _fields(RECEIVE_FIELDS),
                "receiveTime", ("receiveTime",), "receivesItem")
REPORT = Stage("report", 4, ("REPORT_DATA", "XA_REPORT_DATA"), _fields(REPORT_FIELDS),
               "checkTime", ("collectTime", "packTime", "receiveTime", "checkTime"))
HOURLY = Stage("hourly", None, ("HOUR_SUM_REPORT",), _fields(HOURLY_FIELDS))
CHECK_ORG = Stage("check_org", None, ("CHECK_ORG",), _fields(CHECK_ORG_FIELDS))

STAGES = {s.name: s for s in (COLLECT, TRANSPORT, RECEIVE, REPORT)}
ALL_KINDS = (COLLECT, TRANSPORT, RECEIVE, REPORT, HOURLY, CHECK_ORG)

ITEM_TYPE = T.ArrayType(T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("tubeCode", T.StringType()),
    T.StructField("packCode", T.StringType()),
]))

CORRUPT = "_corrupt_record"


def element_schema() -> T.StructType:
    """String-first element layout holding the fields of all kinds. Nested arrays are read as
    text, too, and parsed later: a bad one becomes null like a bad number."""
    names = dict.fromkeys(name for kind in ALL_KINDS for name in kind.fields)
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def envelope_schema() -> T.StructType:
    scalars = [T.StructField(n, T.StringType()) for n in ENVELOPE_FIELDS]
    return T.StructType([
        *scalars,
        T.StructField("data", T.ArrayType(element_schema())),
        T.StructField(CORRUPT, T.StringType()),
    ])


def time_column(field: str) -> str:
    """Name of the parsed timestamp kept beside a string time field."""
    return field.removesuffix("Time") + "Ts"

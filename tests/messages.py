"""Invented messages for the tests."""

import json

from tubetrace.functions.crypto import CipherKey

SECRET = CipherKey(b"test-key-16bytes", b"test-vec-16bytes")

GOOD_ID, GOOD_PHONE = "610101199001011234", "13912345678"


def envelope(kind, data, **changes):
    body = {"userName": "lab-1", "type": kind, "clientId": "7", "numberReport": "111111",
            "interfaceRecTime": "2024-01-05 12:00:00", "dropDataNum": 0, "data": data}
    body.update(changes)
    return json.dumps(body)


def collect(**changes):
    item = {"submitId": 1, "areaId": 6101, "recordId": 5, "personIdCard": GOOD_ID,
            "personName": "Ann", "personPhone": GOOD_PHONE, "personId": "p1",
            "collectLocationCity": "c", "collectLocationDistrict": "d",
            "collectLocationName": "site", "collectOrgName": "org", "tubeCode": "t1",
            "collectTime": "2024-01-05 08:00:00", "addTime": "2024-01-05 08:10:00",
            "collectCount": 1, "collectLimitnum": 10}
    item.update(changes)
    return item


def report(**changes):
    item = {"submitId": 2, "areaId": 6101, "recordId": 6, "personIdCard": GOOD_ID,
            "personName": "Ann", "personPhone": GOOD_PHONE, "personId": "p1",
            "collectLocationCity": "c", "collectLocationDistrict": "d",
            "collectLocationName": "site", "checkOrgName": "lab", "tubeCode": "t1",
            "collectTime": "2024-01-05 08:00:00", "packTime": "2024-01-05 08:30:00",
            "receiveTime": "2024-01-05 09:00:00", "checkTime": "2024-01-05 10:00:00",
            "checkResult": "1", "addtime": "2024-01-05 11:00:00", "collectCount": 1,
            "collectLimitnum": 10}
    item.update(changes)
    return item


def transport(**changes):
    item = {"submitId": 3, "areaId": 6101, "deliveryCode": "d1", "deliveryName": "run",
            "packTime": "2024-01-05 08:30:00", "deliveryTime": "2024-01-05 08:40:00",
            "transportOrgName": "cars", "collectAddress": "site", "tubeNum": 2, "packNum": 1,
            "addtime": "2024-01-05 08:45:00",
            "transportItem": [{"tubeCode": "t1", "packCode": "k"}]}
    item.update(changes)
    return item


def receive(**changes):
    item = {"submitId": 4, "areaId": 6101, "receiveCode": "r1", "receiveName": "desk",
            "receiveTime": "2024-01-05 09:00:00", "deliveryCode": "d1",
            "deliveryPrpId": GOOD_ID, "deliveryPrpPhone": GOOD_PHONE,
            "transportPrpId": GOOD_ID, "transportPrpPhone": GOOD_PHONE,
            "receiveOrgName": "lab", "tubeNum": 2, "packNum": 1,
            "addTime": "2024-01-05 09:05:00", "receivesItem": [{"tubeCode": "t1"}]}
    item.update(changes)
    return item


def frame(spark, *values):
    rows = [(f"m{i:03d}", v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "message_id string, value string")

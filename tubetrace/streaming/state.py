"""Keyed state of the streaming jobs.

Both processors see few rows per key and batch: window rows in one case, the candidates
of one issue in the other. Heavy aggregation happens before them, in Spark's own
operators. State expires a fixed time after it was last written.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

# the processors travel with the query, so workers need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE_TTL_MS = 48 * 3600 * 1000


def _plain(value):
    """A value as the state store takes it."""
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    return value.item() if hasattr(value, "item") else value


class RunningSums(StatefulProcessor):
    """Adds the rows of a key to its sums; first values stay, last non-null ones carry on.

    ``sub_key`` with ``sub_sums`` keeps a second set of sums per value of a column (such
    as the hour) below the key.
    """

    def __init__(self, state_schema, order, sums, firsts=(), lasts=(), sub_key=None,
                 sub_sums=(), ttl_ms=STATE_TTL_MS):
        self.state_schema, self.order, self.ttl_ms = state_schema, list(order), ttl_ms
        self.sums, self.firsts, self.lasts = list(sums), list(firsts), list(lasts)
        self.sub_key, self.sub_sums = sub_key, list(sub_sums)

    def init(self, handle):
        self.totals = handle.getValueState("totals", self.state_schema, self.ttl_ms)
        if self.sub_key:
            values = T.StructType([T.StructField(c, T.LongType()) for c in self.sub_sums])
            key = T.StructType([T.StructField(self.sub_key, T.StringType())])
            self.sub_totals = handle.getMapState("sub_totals", key, values, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        pdf = pd.concat(list(rows)).sort_values(self.order, kind="stable")
        names = [*self.sums, *self.firsts, *self.lasts]
        stored = self.totals.get() if self.totals.exists() else None
        known = dict(zip(names, stored)) if stored else {}
        for c in self.sums:
            pdf[c] = pdf[c].fillna(0).astype("int64").cumsum() + int(known.get(c) or 0)
        for c in self.firsts:
            first = known.get(c)
            pdf[c] = _plain(pdf[c].iloc[0]) if first is None else first
        for c in self.lasts:
            carried = pdf[c].astype("object").where(pdf[c].notna(), None).ffill()
            pdf[c] = carried.where(carried.notna(), known.get(c))
        if self.sub_key:
            # one pass over the rows and two calls to the store per value of the sub key
            places, values = pd.factorize(pdf[self.sub_key])
            nothing = (0,) * len(self.sub_sums)
            stored = [self.sub_totals.getValue((value,)) or nothing for value in values]
            known = places >= 0
            ends = []
            for n, c in enumerate(self.sub_sums):
                column = pdf[c].to_numpy().copy()
                added = pdf[c][known].astype("int64").groupby(places[known]).cumsum().to_numpy()
                column[known] = added + [int(stored[p][n]) for p in places[known]]
                pdf[c] = column
                ends.append(dict(zip(places.tolist(), column.tolist())))
            for place, value in enumerate(values):
                self.sub_totals.updateValue((value,), tuple(int(e[place]) for e in ends))
        end = pdf.iloc[-1]
        self.totals.update(tuple(
            int(end[c]) if c in self.sums else _plain(end[c]) for c in names))
        yield pdf

    def close(self):
        pass


def stream_running(rows: DataFrame, key: str, order, sums, firsts=(), lasts=(), sub_key=None,
                   sub_sums=(), ttl_ms: int = STATE_TTL_MS) -> DataFrame:
    """Streaming form of ``running_accumulate``: every row with the sums of its key so far."""
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    names = [*sums, *firsts, *lasts]
    state = T.StructType([
        T.StructField(c, T.LongType() if c in sums else kinds[c]) for c in names])
    processor = RunningSums(state, order, sums, firsts, lasts, sub_key, sub_sums, ttl_ms)
    return rows.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=rows.schema, outputMode="append",
        timeMode="processingTime")


class IssueState(StatefulProcessor):
    """Follows one issue: errors are kept, a pass only while the issue is open."""

    SCHEMA = T.StructType([
        T.StructField("is_open", T.BooleanType()), T.StructField("closed", T.BooleanType()),
        T.StructField("number", T.LongType()), T.StructField("id", T.LongType()),
        T.StructField("add_time", T.StringType())])

    def __init__(self, order, reopen=True, ttl_ms=None):
        self.order, self.reopen, self.ttl_ms = list(order), reopen, ttl_ms

    def init(self, handle):
        self.issue = handle.getValueState("issue", self.SCHEMA, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        pdf = pd.concat(list(rows)).sort_values(self.order, kind="stable")
        stored = self.issue.get() if self.issue.exists() else None
        is_open, closed, number, id_, add_time = stored or (False, False, 0, None, None)
        kept = []
        for row in pdf.itertuples():
            error = row.is_valid == 0
            if error and not is_open:
                number, id_, add_time = number + 1, int(row.id), row.add_time
            if error or is_open:
                kept.append((row.Index, number, id_, add_time))
            if error:
                is_open = self.reopen or not closed
            elif is_open:
                is_open, closed = False, True
        if number:
            self.issue.update((is_open, closed, number, id_, add_time))
        if kept:
            index, numbers, ids, times = zip(*kept)
            out = pdf.loc[list(index)].copy()
            out["issue_number"], out["id"], out["add_time"] = numbers, ids, times
            yield out

    def close(self):
        pass


def stream_issues(candidates: DataFrame, key: str, order, reopen: bool = True,
                  ttl_ms: int | None = None) -> DataFrame:
    """Streaming form of the issue lifecycle.

    Candidates have ``is_valid``, ``id`` and ``add_time``. The rows that are kept take id
    and add time of the row that opened the issue, and its number.
    """
    schema = T.StructType([*candidates.schema.fields, T.StructField("issue_number", T.LongType())])
    return candidates.groupBy(key).transformWithStateInPandas(
        statefulProcessor=IssueState(order, reopen, ttl_ms), outputStructType=schema,
        outputMode="append", timeMode="none" if ttl_ms is None else "processingTime")

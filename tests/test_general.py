"""Rejects, drift, shredding and timestamps on small tables."""

import dataclasses
import json
import time
from datetime import UTC, datetime, timedelta
from zoneinfo import ZoneInfo

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from resma import problems
from resma.operators import drift, rejects, shred, timestamps

SCHEMA = "record_id long, dataset_id string, raw_json string"


def number(i: int) -> str:
    body = f"{i:07}" + "20258050274"
    check = 98 - int(body + "00") % 97
    return f"{i:07}-{check:02}.2025.8.05.0274"


def record(i: int, **more) -> dict:
    return {"process_number": number(i), "projudi_internal_id": str(1000 + i), "x": i} | more


def test_reject_reasons(spark):
    good = [record(i) for i in range(1, 7)]
    lines = [(i, "f", json.dumps(r)) for i, r in enumerate(good)]
    lines += [
        (100, "f", None), (101, "f", ""), (102, "f", '{"x":NaN}'), (103, "f", '{"x":1,"x":2}'), (104, "f", "[]"), (105, "f", json.dumps(record(9) | {"y": 1})),
        (106, "f", json.dumps(record(9) | {"process_number": number(9)[:-1] + "5"})), (107, "f", json.dumps(record(9) | {"projudi_internal_id": 5})), (108, "f", json.dumps(record(9) | {"projudi_internal_id": "1" * 21})),
        (109, "f", json.dumps(record(9) | {"process_number": None})), (110, None, json.dumps(record(9))),
    ]
    lines += [(200 + i, "ints", json.dumps(record(i) | {"projudi_internal_id": i})) for i in range(3)]
    lines += [(210, "ints", json.dumps(record(4))), (211, "ints", json.dumps(record(4) | {"projudi_internal_id": -1}))]
    got = {r["record_id"]: r["reason"] for r in rejects.rejected_records(spark.createDataFrame(lines, SCHEMA)).collect()}
    assert got == {100: "broken_json", 101: "broken_json", 102: "broken_json", 103: "duplicate_key", 104: "not_object", 105: "field_set", 106: "process_number", 107: "projudi_internal_id",
                   108: "projudi_internal_id", 109: "process_number", 210: "projudi_internal_id", 211: "projudi_internal_id"}
    assert rejects.loaded_records(spark.createDataFrame(lines, SCHEMA)).count() == len(lines) - len(got)
    assert rejects.rejected_records(spark.createDataFrame([], SCHEMA)).count() == 0


def test_rejects_do_not_depend_on_partitions(spark, data):
    from resma.sources.tables import table

    lines = table(spark, data, "dataset_records")
    results = [sorted(map(tuple, rejects.rejected_records(lines.repartition(n)).select("record_id", "reason").collect())) for n in (1, 5)]
    assert results[0] == results[1]
    # clashing and extra columns pass through
    more = lines.withColumn("n", lines.record_id).withColumn("_extra", lines.record_id)
    assert set(rejects.rejected_records(more).columns) == {*more.columns, "reason"}


def test_drift(spark):
    def rec(i, **more):
        return json.dumps({"process_number": number(i)} | more)

    a = [rec(i, year=2000 + i, kind="k%d" % (i % 5), n=i, deep={"p": 1, "q": [{"r": 1}]}, only_null=None) for i in range(30)]
    b = [rec(i, ano=2000 + i, size=i * 7 % 11, n=str(i), deep={"p": 1, "q": [{"r": "1", "s": 2}]}) for i in range(20, 60)]
    lines = [(i, "A", t) for i, t in enumerate(a)] + [(100 + i, "B", t) for i, t in enumerate(b)]
    files = spark.createDataFrame(
        [("A", "/c/f/2025-01-01.jsonl", '{"version": 2, "total": 30, "made_em": "2025-01-01", "filtro": {"a": 1}}', 30), ("B", "/c/f/2025-02-01.jsonl", '{"version": "2", "linhas": 40, "filtro_aplicado": {"a": 2}, "novo": true}', 40), ("C", "/c/g/2025-02-01.jsonl", None, 0)],
        "dataset_id string, input_path string, metadata_json string, record_count long",
    )
    order = drift.file_order(files)
    got = sorted(tuple(r) for r in drift.record_drift(spark.createDataFrame(lines, SCHEMA), order).select("file", "drift", "old_field", "new_field").collect())
    assert got == [
        ("B", "added", "", "deep.q[].s"), ("B", "added", "", "size"), ("B", "removed", "kind", ""), ("B", "removed", "only_null", ""), ("B", "renamed", "year", "ano"),
        ("B", "type_changed", "deep.q[].r", "deep.q[].r"), ("B", "type_changed", "n", "n"),
    ]
    side = sorted(tuple(r) for r in drift.sidecar_drift(files, order).collect())
    assert side == [("B", "added", "", "novo"), ("B", "removed", "made_em", ""), ("B", "renamed", "filtro", "filtro_aplicado"), ("B", "renamed", "total", "linhas"), ("B", "type_changed", "version", "version")]
    assert drift.record_drift(spark.createDataFrame([], SCHEMA), order).count() == 0


def test_nothing_below_what_is_told():
    old = {"a": "object", "a.b": "object", "a.b.c": "integer", "l": "array", "l[]": "string"}
    new = {"a": "object", "l": "array", "l[]": "object", "l[].x": "integer"}
    assert drift.schema_changes(old, new) == [("removed", "a.b", "", "object"), ("type_changed", "l[]", "l[]", "object")]
    # members of a lone object do not stand where most records have a list
    assert drift.standing({"a": "array", "a.x": "integer", "a[]": "object", "a[].x": "integer"}) == {"a": "array", "a[]": "object", "a[].x": "integer"}


def test_union_schema(spark, data):
    assert drift.promote({"integer", "number"}) == "number"
    assert drift.promote({"integer", "string", "null"}) == "string"
    assert drift.promote({"null"}) == "null"
    table = problems.p3_records(spark, data)
    assert table.count() == problems.p2_loaded(spark, data).count()
    assert "process_number" in table.columns


def test_union_table_loses_nothing(spark):
    big, huge = (1 << 53) + 1, 1 << 70
    records = [
        {"k": 1, "x.y": "a", "n": 1, "old": "u", "b": True, "l": [1]}, {"k": 2, "n": 2.5, "b": False, "l": {"z": None}}, {"k": "seven", "n": None, "new": "v", "g": big},
        {"old": "both", "new": "kept", "g": 5, "h": huge, "K": 9, "record_id": "mine", "more": [0], "m": big}, {"h": 1, "m": 0.5},
    ]
    frame = spark.createDataFrame([(i, "f", json.dumps(r)) for i, r in enumerate(records)], SCHEMA)
    counts = drift.header_counts(frame, "dataset_id", "raw_json")
    renames = spark.createDataFrame([("f", "old", "new")], "file string, old_field string, new_field string")
    schema = drift.union_schema(counts, renames)
    assert schema.columns == {"K": "integer", "b": "boolean", "g": "long", "h": "string", "k": "string", "l": "string", "m": "string", "more": "array", "n": "number", "old": "string", "record_id": "string", "x.y": "string"} and schema.column_of["new"] == "old"
    table = drift.unified(frame, ["record_id", "dataset_id"], "raw_json", schema)
    assert [c.lower() for c in table.columns] == sorted({c.lower() for c in table.columns}, key=[c.lower() for c in table.columns].index)
    rows = table.orderBy("record_id").collect()
    assert [r["k_"] for r in rows] == ["1", "2", "seven", None, None] and [r["x.y"] for r in rows][0] == "a"
    assert (rows[2]["g"], rows[3]["g"], rows[3]["h"], rows[3]["m"]) == (big, 5, str(huge), str(big))
    assert [r["old"] for r in rows] == ["u", None, "v", "both", None] and rows[3]["more"] == {"new": '"kept"'}
    # every value comes back
    few = drift.union_schema(counts, renames, most=2)
    for schema in (schema, few):
        got = drift.unified(frame, ["record_id", "dataset_id"], "raw_json", schema).orderBy("record_id").collect()
        for record, row in zip(records, got):
            held = [v for c, v in row.asDict().items() if c not in ("record_id", "dataset_id", "more") and v is not None]
            assert len(held) + len(row["more"]) == sum(v is not None for v in record.values())


def brute_nodes(value, path, parent, element, lists, out, decode, whole):
    if decode and isinstance(value, str):
        try:
            v = json.loads(value)
            value = v if isinstance(v, dict) else value
        except ValueError:
            pass
    if value is None:
        return
    if isinstance(value, list):
        for i, x in enumerate(value):
            brute_nodes(x, f"{path}[{i}]", parent, True, lists, out, decode, False)
    elif isinstance(value, dict):
        out.append((parent, path))
        for k, v in value.items():
            brute_nodes(v, f"{path}.{k}", path, False, lists, out, decode, False)
    elif element or whole:
        out.append((parent, path))


def shape_counts(spark, records, shape):
    from collections import Counter

    n = Counter(x for r in records for x in shred.shapes(r, shape))
    return spark.createDataFrame([(*k, v) for k, v in n.items()], "path string, type string, n long")


def test_shred_is_linear_in_depth(spark):
    shape = shred.Shape(("a",))
    value = {"z": 1}
    for i in range(200):
        value = [value] if i % 3 == 0 else {"k": value, "n": i}
    began = time.perf_counter()
    assert len(shred.shapes({"a": value}, shape)) < 1000
    rows = shred.shred(1, {"a": value}, shape)
    assert time.perf_counter() - began < 1 and len(rows) > 200
    deep = '{"a":' * 30_000 + "1" + "}" * 30_000
    got = shred.adjacency(spark.createDataFrame([(1, "f", deep), (2, "f", '{"a":{"\\ud800":"\\udfff"}}')], SCHEMA), shape).collect()
    assert [(r["record_id"], r["kind"]) for r in got] == [(1, "unread"), (2, "node"), (2, "scalar")]


def test_entity_table_keeps_labels_beyond_the_columns(spark):
    shape = shred.Shape(("o",), whole=frozenset({"o"}))
    records = [{"o": {"a": 1, "b": 2, "A": 3, "node": 4}}, {"o": {"a": 5}}]
    frame = spark.createDataFrame([(i, "f", json.dumps(r)) for i, r in enumerate(records)], SCHEMA)
    labels, others = shred.entity_labels(shape_counts(spark, records, shape), "o", shape, most=1)
    assert labels == ["a"] and others
    got = shred.entity_table(shred.adjacency(frame, shape, entity="o"), "o", labels, others).orderBy("record_id").collect()
    assert [(r["a"], r["others"]) for r in got] == [("1", {"A": "3", "b": "2", "node": "4"}), ("5", {})]
    labels, others = shred.entity_labels(shape_counts(spark, records, shape), "o", shape)
    assert (labels, others) == (["A", "a", "b", "node"], False)
    wide = shred.entity_table(shred.adjacency(frame, shape, entity="o"), "o", labels)
    assert wide.columns == ["record_id", "node_path", "parent_path", "ordinal", "value", "A", "a_", "b", "node_"]


def test_shred(spark, data):
    lines = [
        (1, "f", json.dumps({"a": {"n": 1, "items": [{"id": 1}, None, {"id": 2, "parts": [{"z": 1}]}]}, "l": ["x", None, "y"], "o": "text"})),
        (2, "f", json.dumps({"a": json.dumps({"n": 1, "items": []}), "l": "lone", "o": {"name": "n", "value": 3}})),
        (3, "f", json.dumps({"a": None, "l": [], "o": None})),
        (4, "f", json.dumps({"l": ["z"], "a": {"items": {"id": 3}}})),
    ]
    shape = shred.Shape(("a", "l", "o"), frozenset({"a"}), frozenset({"o"}))
    records = spark.createDataFrame(lines, SCHEMA)
    counts = shape_counts(spark, [json.loads(x[2]) for x in lines], shape)
    shape = dataclasses.replace(shape, lists=shred.lone_lists(counts))
    got = shred.adjacency(records, shape)
    nodes = sorted((r["record_id"], r["parent_path"], r["node_path"]) for r in shred.nodes(got).collect())
    assert nodes == sorted([
        (1, "", "a"), (1, "a", "a.items[0]"), (1, "a", "a.items[2]"), (1, "a.items[2]", "a.items[2].parts[0]"), (1, "", "l[0]"), (1, "", "l[2]"), (1, "", "o"),
        (2, "", "a"), (2, "", "l[0]"), (2, "", "o"), (4, "", "l[0]"), (4, "", "a"), (4, "a", "a.items[0]"),
    ])
    rows = {r["node_path"]: r.asDict() for r in shred.entity_table(got, "a.items[]", *shred.entity_labels(counts, "a.items[]", shape)).where("record_id = 1").collect()}
    assert rows["a.items[2]"]["id"] == "2" and rows["a.items[2]"]["ordinal"] == 2 and rows["a.items[2]"]["parent_path"] == "a"
    clash = shred.entity_table(got, "o", ["name", "value"]).where("record_id = 2").collect()[0]
    assert clash["value_"] == "3" and clash["value"] is None


def test_p4_against_brute_force(spark, data):
    got = {(r["record_id"], r["parent_path"], r["node_path"]) for r in problems.p4_found(spark, data).collect()}
    want = set()
    lone = {"avisos", "datajud_subjects"}
    for r in problems.p2_loaded(spark, data).collect():
        rec = json.loads(r["raw_json"])
        for f in problems.NESTED.fields:
            out, v = [], rec.get(f)
            if f in lone and v is not None and not isinstance(v, list):
                v = [v]
            brute_nodes(v, f, "", False, None, out, f == "arquivos", f == "orgao_julgador")
            want |= {(r["record_id"], p, n) for p, n in out}
    assert got == want


UTC_CASES = {
    "2025-04-03T12:02:17Z": "2025-04-03T12:02:17.000000Z", "3 de Abril de 2025 às 09:02:17": "2025-04-03T12:02:17.000000Z", "03/04/2025 09:02": "2025-04-03T12:02:00.000000Z", "03-04-25 09h02": "2025-04-03T12:02:00.000000Z",
    "Thu, 03 Apr 2025 09:02:17 -0300": "2025-04-03T12:02:17.000000Z", "1743681737": "2025-04-03T12:02:17.000000Z", "1743681737123": "2025-04-03T12:02:17.123000Z", "20250403": "2025-04-03T03:00:00.000000Z", "20250403090217": "2025-04-03T12:02:17.000000Z",
    "2025-04-03T09:02:17.123456789-0300": "2025-04-03T12:02:17.123456Z", "2026-05-04T11:19:59+01:00[Europe/Lisbon]": "2026-05-04T10:19:59.000000Z", "2026-06-16 17:33:58 Europe/Lisbon": "2026-06-16T16:33:58.000000Z",
    "12/05/2026 12:50:36 EDT": "2026-05-12T16:50:36.000000Z", "07/12/2014 13:39:21 BRST": "2014-12-07T15:39:21.000000Z", "31/02/2025 10:00": None, "2025-13-01T00:00:00Z": None, "": None, "sem data": None, None: None, "0": None, "03/04/2025 24:00": None,
    "2011-10-16 00:30:00 America/Bahia": None, "2011-12-01 12:00:00": "2011-12-01T14:00:00.000000Z", "2025-11-02T01:30[America/New_York]": "2025-11-02T05:30:00.000000Z", "2025-01-01 00:00:00 Mars/Olympus": None,
}


def test_moments():
    assert dict(zip(UTC_CASES, timestamps.to_utc_text(list(UTC_CASES)))) == UTC_CASES
    assert timestamps.to_local_date(["2025-04-03T01:00:00Z", "16/10/2011", "1743681737000", "31/02/2025", None]) == ["2025-04-02", "2011-10-16", "2025-04-03", None, None]


@settings(max_examples=300, deadline=None)
@given(st.datetimes(datetime(1950, 1, 1), datetime(2090, 1, 1)), st.sampled_from(["America/Bahia", "America/Sao_Paulo", "America/New_York", "Europe/Lisbon"]))
def test_wall_clock_against_zoneinfo(wall, zone):
    wall = wall.replace(microsecond=0)
    aware = wall.replace(tzinfo=ZoneInfo(zone))
    utc = aware.astimezone(UTC)
    exists = utc.astimezone(ZoneInfo(zone)).replace(tzinfo=None) == wall
    got = timestamps.to_utc_text([f"{wall:%Y-%m-%d %H:%M:%S} {zone}"])[0]
    assert got == (utc.strftime("%Y-%m-%dT%H:%M:%S.000000Z") if exists else None)


@given(st.integers(-700_000, 2_000_000))
def test_civil_days(n):
    import numpy as np

    y, m, d = (int(x) for x in timestamps.civil_date(np.array([n]))[:3])
    assert int(timestamps.civil_days(np.array([y]), np.array([m]), np.array([d]))[0]) == n
    if -700_000 < n < 2_000_000 and 1 <= y <= 9999:
        assert datetime(1970, 1, 1) + timedelta(days=n) == datetime(y, m, d)


@pytest.mark.parametrize("name", sorted(problems.QUERIES))
def test_queries_run(spark, data, name):
    assert problems.QUERIES[name](spark, data).count() >= 0

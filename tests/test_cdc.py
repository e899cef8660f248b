import json

from pyspark.sql import functions as F

from strata.operators import cdc

MSG = "topic string, partition int, offset bigint, value string"


def env(op, before=None, after=None, ts_ms=1704067200000, **extra):
    d = {"before": before, "after": after, "ts_ms": ts_ms, **extra}
    if op is not None:
        d["op"] = op
    return json.dumps(d)


def msgs(spark, rows):
    return spark.createDataFrame(rows, MSG)


def test_parse_envelope_edge_rows(spark):
    t = "abc.hr.employees"
    rows = [
        (t, 0, 1, env(None, after={"id": 1})),                      # op missing -> INSERT
        (t, 0, 2, env("x", after={"id": 2})),                       # unknown op -> INSERT
        (t, 0, 3, env("u")),                                        # before and after null
        (t, 0, 4, env("u", after={"name": "n"})),                   # after without id -> ''
        (t, 0, 5, json.dumps({"op": "c", "after": {"id": 5}})),     # ts_ms missing -> epoch
        (t, 0, 6, None),                                            # tombstone -> dropped
        (t, 0, 7, "{not json"),                                     # invalid -> quarantine
        (t, 0, 8, json.dumps({"id": 8, "basic_salary": 12.5, "__op": "u", "__ts_ms": 1704067200000})),
        ("abc.finance", 0, 9, env("c", after={"id": 9})),           # bad topic
        ("abc.hr.vendors", 0, 10, env("c", after={"id": 10})),      # table not captured by hr
    ]
    parsed = cdc.parse_envelope(msgs(spark, rows))
    ok, bad = cdc.split_valid(parsed)
    got = {r.kafka_offset: r for r in ok.collect()}
    assert sorted(got) == [1, 2, 3, 4, 5, 8]
    assert got[1].operation == "INSERT" and got[2].operation == "INSERT"
    assert got[3].after_state is None and got[3].before_state is None and got[3].record_id == ""
    assert got[4].record_id == ""
    assert str(got[5].event_ts) == "1970-01-01 00:00:00"
    assert got[8].operation == "UPDATE" and got[8].record_id == "8"
    assert json.loads(got[8].after_state)["basic_salary"] == 12.5
    reasons = {r.kafka_offset: r.reject_reason for r in bad.collect()}
    assert reasons == {7: "invalid json", 9: "topic has fewer than 3 parts",
                       10: "table not captured for department"}


def test_append_cdc_log_dedup(spark):
    t = "abc.hr.employees"
    a = [(t, 0, 1, env("c", after={"id": 1})), (t, 0, 1, env("c", after={"id": 1})),
         (t, 1, 1, env("c", after={"id": 2}))]
    log1 = cdc.split_valid(cdc.parse_envelope(msgs(spark, a)))[0]
    first = cdc.append_cdc_log(None, log1)
    assert first.count() == 2                       # same offset twice -> once; other partition kept
    b = [(t, 0, 1, env("c", after={"id": 1})), (t, 0, 2, env("u", after={"id": 1}))]
    log2 = cdc.split_valid(cdc.parse_envelope(msgs(spark, b)))[0]
    new = cdc.append_cdc_log(first, log2)
    assert [(r.kafka_partition, r.kafka_offset) for r in new.collect()] == [(0, 2)]


def _log(spark, events, topic="abc.hr.employees", partition=0):
    rows = [(topic, partition, off, env(op, before=b, after=a, ts_ms=1704067200000 + off * 1000))
            for off, op, b, a in events]
    return cdc.split_valid(cdc.parse_envelope(msgs(spark, rows)))[0]


def _state(df):
    return {(r.subsidiary_id, r.id): r for r in df.collect()}


def test_merge_changes_semantics(spark):
    events = [
        (1, "c", None, {"id": 1, "employee_id": "E1", "position": "Staff", "basic_salary": 100.5}),
        (2, "u", None, {"id": 1, "position": "Manager"}),                 # partial image
        (3, "c", None, {"id": 2, "employee_id": "E2", "position": "Staff"}),
        (4, "d", {"id": 2}, None),                                        # soft delete
        (5, "d", {"id": 3}, None),                                        # delete of unknown key
        (6, "c", None, {"id": 4, "employee_id": "E4", "department": "X"}),
        (7, "d", {"id": 4}, None),
        (8, "u", None, {"id": 4, "department": "Y"}),                     # resurrection
        (9, "u", None, {"id": 1, "department": None}),                    # explicit null
    ]
    st = _state(cdc.merge_changes(None, _log(spark, events), "employees"))
    assert set(st) == {("ABC", 1), ("ABC", 2), ("ABC", 4)}
    e1 = st[("ABC", 1)]
    assert (e1.employee_id, e1.position, float(e1.basic_salary), e1.department) == ("E1", "Manager", 100.5, None)
    assert e1.is_deleted is False and e1.cdc_operation == "UPDATE" and e1.source_dept == "hr"
    e2 = st[("ABC", 2)]
    assert e2.is_deleted is True and e2.position == "Staff" and str(e2.deleted_at) == "2024-01-01 00:00:04"
    e4 = st[("ABC", 4)]
    assert e4.is_deleted is False and e4.deleted_at is None and e4.department == "Y"


def test_merge_is_order_independent_and_replay_safe(spark):
    events = [(i, "u" if i > 1 else "c", None, {"id": 1, "position": f"p{i}"}) for i in range(1, 7)]
    log = _log(spark, events)
    one_shot = _state(cdc.merge_changes(None, log, "employees"))
    # update before insert (batches arrive out of order) and an old batch replayed
    late = log.filter(F.col("kafka_offset") >= 4)
    early = log.filter(F.col("kafka_offset") < 4)
    s1 = cdc.merge_changes(None, late, "employees")
    s2 = cdc.merge_changes(s1, early, "employees")
    s3 = cdc.merge_changes(s2, early, "employees")    # replay
    for s in (s2, s3):
        got = _state(s)
        assert got[("ABC", 1)].position == one_shot[("ABC", 1)].position == "p6"
        assert got[("ABC", 1)].cdc_offset == 6


def test_two_tenants_same_id(spark):
    a = _log(spark, [(1, "c", None, {"id": 1, "position": "A"})], topic="abc.hr.employees")
    b = _log(spark, [(1, "c", None, {"id": 1, "position": "B"})], topic="xyz.hr.employees")
    st = _state(cdc.merge_changes(None, a.unionByName(b), "employees"))
    assert st[("ABC", 1)].position == "A" and st[("XYZ", 1)].position == "B"


def test_typed_dates_from_int_days_and_text(spark):
    events = [(1, "c", None, {"id": 1, "date_hired": 19723}), (2, "c", None, {"id": 2, "date_hired": "2024-01-01"})]
    st = _state(cdc.merge_changes(None, _log(spark, events), "employees"))
    assert str(st[("ABC", 1)].date_hired) == "2024-01-01" == str(st[("ABC", 2)].date_hired)

"""Message decoding, storing, restarts, late bookings."""

import json

import pytest
from pyspark.sql import functions as F

from yieldline import schemas
from yieldline.operators import checks
from yieldline.plans import models
from yieldline.plans.refresh import full_refresh
from yieldline.session import new_folder
from yieldline.sources import topic
from yieldline.sources.tables import Warehouse
from yieldline.streaming import boards, hourly
from yieldline.streaming.ingest import Ingest

GOOD = {
    "booking_id": "b01",
    "serial_number": "S1",
    "station_number": "1003",
    "book_state": "PASS",
    "date_created": "2025-10-25T10:00:00",
    "part_number": "P1",
    "cycle_time": 4.0,
    "test_count": 1,
}


def message(drop=(), **changes):
    payload = {k: v for k, v in {**GOOD, **changes}.items() if k not in drop}
    return json.dumps({"schema": {"type": "struct", "fields": []}, "payload": payload})


def declared(types, **changes):
    """A message whose schema declares some fields."""
    body = json.loads(message(**changes))
    body["schema"]["fields"] = [{"field": name, **kind} for name, kind in types.items()]
    return json.dumps(body)


def decode(spark, *texts):
    return topic.decode(spark.createDataFrame([(t,) for t in texts], "value STRING"))


@pytest.mark.parametrize(
    "text, reason",
    [
        (message(), None),
        (message()[:-5], "not a JSON message"),
        ("hello", "not a JSON message"),
        ('{"schema": {}}', "no payload"),
        ('{"payload": null}', "no schema"),
        ('{"payload": {"booking_id": "b"}}', "no schema"),
        (message(date_created=9223372036854775807), "date_created is not a timestamp"),
        (message(date_created=99999999999999999999), "date_created is not a timestamp"),
        (message(date_created=999999999999999), "date_created is not a timestamp"),
        (message(date_created="2950-01-01T00:00:00"), "date_created is out of range"),
        (message(date_created=-1), "date_created is out of range"),
        (message(booking_id=None), "booking_id is missing"),
        (message(drop=["serial_number"]), "serial_number is missing"),
        (message(cycle_time="fast"), "cycle_time is not a decimal(10,2)"),
        (message(cycle_time=123456789.5), "cycle_time is not a decimal(10,2)"),
        (message(date_created="soon"), "date_created is not a timestamp"),
        (message(test_count="x"), "test_count is not a integer"),
        (message(station_number="10031"), "station_number is longer than 4"),
        (message(station_number="1003  "), None),
        (message(part_number="P" * 11, book_state=None), "book_state is missing; part_number is longer than 10"),
    ],
)
def test_reason(spark, text, reason):
    assert decode(spark, text).select("reason").first()[0] == reason


def test_encodings_and_defaults(spark):
    rows = decode(
        spark,
        message(drop=["test_count"]),
        message(test_count=None),
        message(cycle_time="4.125", date_created=1761386400123),
        message(date_created="2025-10-25 10:00:00.5", station_number="1003   "),
        message(date_created="2025-10-25T10:00:00+02:00"),
        message(date_created=1000),
        declared({"date_created": {"type": "int64", "name": topic.TIMESTAMP_TYPE}}, date_created=1761386400123),
        declared({"cycle_time": {"type": "bytes", "name": topic.DECIMAL_TYPE, "parameters": {"scale": "2"}}}, cycle_time="Ang="),
        declared({"cycle_time": {"type": "bytes", "name": topic.DECIMAL_TYPE, "parameters": {"scale": "1"}}}, cycle_time="/w=="),
    ).select("test_count", F.col("cycle_time").cast("string"), F.col("date_created").cast("string"), "station_number")
    assert [tuple(r) for r in rows.collect()] == [
        (1, "4.00", "2025-10-25 10:00:00", "1003"),
        (None, "4.00", "2025-10-25 10:00:00", "1003"),
        (1, "4.13", "2025-10-25 10:00:00.123", "1003"),
        (1, "4.00", "2025-10-25 10:00:00.5", "1003"),
        (1, "4.00", "2025-10-25 10:00:00", "1003"),
        (1, "4.00", "1970-01-01 00:00:01", "1003"),
        (1, "4.00", "2025-10-25 10:00:00.123", "1003"),
        (1, "6.32", "2025-10-25 10:00:00", "1003"),
        (1, "-0.10", "2025-10-25 10:00:00", "1003"),
    ]


def test_decode_parses_each_message_once(spark):
    plan = decode(spark, message())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_message_round_trip(make_bookings):
    bookings = make_bookings(
        [("b1", "S1", "1003", "PASS", "2025-03-30T02:30:00.123456", "P1", "4.10", None)]
    )
    back = topic.valid(topic.decode(topic.envelope(bookings))).select(*topic.FIELDS)
    assert back.collect() == bookings.collect()


@pytest.fixture
def warehouse(spark):
    return Warehouse(spark, new_folder(spark, "test")).create()


def land(warehouse, *texts):
    frame = warehouse.spark.createDataFrame([(t,) for t in texts], "value STRING")
    frame.coalesce(1).write.mode("append").text(warehouse.path("landing"))


def run(ingest, **trigger):
    warehouse = ingest.warehouse
    stream = topic.read_landing(warehouse.spark, warehouse.path("landing"), maxFilesPerTrigger="1")
    ingest.start(stream, warehouse.path("checkpoint"), **trigger).awaitTermination()


def ids(frame):
    return sorted(r[0] for r in frame.select("booking_id").collect())


def test_restart_duplicates_quarantine_and_added_columns(warehouse):
    ingest = Ingest(warehouse)
    land(warehouse, message(), message(cycle_time=9.0), "broken", message(booking_id="b02"))
    run(ingest)
    land(warehouse, message(), message(booking_id="b03", operator="Kim", Booking_ID="x"))
    run(ingest)
    assert ids(warehouse.facts()) == ["b01", "b02", "b03"]
    assert [(r.value, r.reason) for r in ingest.quarantine().collect()] == [("broken", "not a JSON message")]
    operators = {r.booking_id: r.operator for r in warehouse.facts_with_added_columns(["operator"]).collect()}
    assert operators == {"b01": None, "b02": None, "b03": "Kim"}
    assert {r.name: r.bookings for r in warehouse.added_fields().collect()} == {"operator": 1, "Booking_ID": 1}


def test_every_added_field_is_kept(warehouse):
    """Thousands of new names, reserved, dotted, empty and differing by case only; nothing stops the stream."""
    many = {f"field_{i}": str(i) for i in range(2000)}
    odd = {"offset": "1", "batch_id": "2", "event_day": "3", "meta.line": "4", "Operator": "A", "operator": "B", "a`b": "5", "": "6"}
    ingest = Ingest(warehouse)
    land(warehouse, message(**many), message(booking_id="b02", **odd), message(booking_id="b03", operator="C"))
    run(ingest)
    land(warehouse, message(booking_id="b04", date_created=9223372036854775807), message(booking_id="b05"))
    run(ingest)
    extras = {r.booking_id: r.extras for r in warehouse.wide_facts().collect()}
    assert extras == {"b01": many, "b02": odd, "b03": {"operator": "C"}, "b05": None}
    found = {r.booking_id: (r["meta.line"], r["operator"]) for r in warehouse.facts_with_added_columns(["meta.line", "operator"]).collect()}
    assert found == {"b01": (None, None), "b02": ("4", "B"), "b03": (None, "C"), "b05": (None, None)}
    assert ids(ingest.quarantine().selectExpr("get_json_object(value, '$.payload.booking_id') AS booking_id")) == ["b04"]


def test_a_new_checkpoint_and_a_second_stream_lose_nothing(warehouse):
    """Batch ids start at 0 again; nothing of the earlier stream is taken for the new one's, or overwritten."""
    ingest = Ingest(warehouse)
    land(warehouse, message(), message(booking_id="b02", date_created="2025-10-25T12:00:00"))
    run(ingest)
    land(warehouse, message(booking_id="b03"), "broken")
    stream = topic.read_landing(warehouse.spark, warehouse.path("landing"))
    ingest.start(stream, warehouse.path("second-checkpoint")).awaitTermination()
    assert ids(warehouse.facts()) == ["b01", "b02", "b03"]
    assert ingest.quarantine().count() == 1
    assert sorted(warehouse.log.marks().values()) == [0, 0]


def test_a_third_of_a_folder_per_stream_in_boards_and_windows(spark, make_bookings, warehouse):
    def booking(i, state, attempt):
        return (f"b{i}", "S1", "1003", state, f"2025-10-25T10:0{i}:00", "P1", "4.00", attempt)

    for n, part in enumerate(([booking(1, "FAIL", 1)], [booking(2, "PASS", 2)])):
        rows = make_bookings(part)
        rows.write.parquet(warehouse.path(f"arriving-{n}"))
        stream = spark.readStream.schema(rows.schema).parquet(warehouse.path(f"arriving-{n}"))
        boards.start_boards(stream, warehouse.path("boards"), warehouse.path(f"boards-{n}")).awaitTermination()
        hours = hourly.hourly_counts(stream)
        hourly.start_windows(hours, warehouse.path("hours"), warehouse.path(f"hours-{n}")).awaitTermination()
        hourly.start_routed(warehouse, stream, "routed", warehouse.path(f"routed-{n}"), 3600).awaitTermination()
    assert [(r.latest_attempt, r.failed, r.passed) for r in boards.last_results(spark, warehouse.path("boards")).collect()] == [(2, False, True)]
    keys = ["station_number", "part_number", "date_hour"]
    assert [r.count_bookings for r in hourly.latest_windows(hours, warehouse.path("hours"), keys).collect()] == [2]
    assert [r.count_bookings for r in hourly.Routed(warehouse, "routed").totals().collect()] == [2]


def test_replayed_batch_stores_nothing_twice(warehouse):
    ingest = Ingest(warehouse)
    batch = warehouse.spark.createDataFrame([(message(),), (message(booking_id="b02"),)], "value STRING")
    for _ in range(3):
        ingest.store(batch, 0)
    assert ids(warehouse.facts()) == ["b01", "b02"]


def test_append_keeps_the_first_row_of_an_id(warehouse, make_bookings):
    def booking(serial, at):
        return ("b1", serial, "1003", "PASS", at, "P1", "1.00", 1)

    warehouse.append_facts(make_bookings([booking("S2", "2025-10-26T10:00:00"), booking("S1", "2025-10-25T10:00:00")]))
    warehouse.append_facts(make_bookings([booking("S3", "2025-10-24T10:00:00")]))
    assert [r.serial_number for r in warehouse.facts().collect()] == ["S1"]


def test_late_bookings_are_listed_and_stored(warehouse):
    ingest = Ingest(warehouse, late_after=3600)
    land(warehouse, message(date_created="2025-10-25T10:00:00"))
    run(ingest)
    land(
        warehouse,
        message(booking_id="b02", date_created="2025-10-25T07:59:59"),
        message(booking_id="b03", date_created="2025-10-25T08:00:00"),
    )
    run(ingest)
    assert ids(ingest.late()) == ["b02", "b03"]
    land(warehouse, message(booking_id="b04", date_created="2025-10-25T09:00:00"))
    run(ingest)
    assert ids(ingest.late()) == ["b02", "b03"]
    assert ids(warehouse.facts()) == ["b01", "b02", "b03", "b04"]


def test_windows_hold_every_booking(spark, make_bookings, warehouse):
    """Late by hours, or stamped in the far future, and over restarts too."""
    def booking(i, at):
        return (f"b{i}", f"S{i}", "1003", "PASS" if i % 2 else "FAIL", at, "P1", "4.00", 1)

    parts = (
        [booking(1, "2025-10-25T10:00:00"), booking(2, "2025-10-25T10:30:00"), booking(9, "2099-01-01T00:00:00")],
        [booking(3, "2025-10-25T10:10:00"), booking(4, "2025-10-25T11:10:00")],
        [booking(5, "2025-10-24T23:00:00"), booking(6, "2025-10-25T10:40:00")],
    )
    for part in parts:
        rows = make_bookings(part)
        rows.coalesce(1).write.mode("append").parquet(warehouse.path("arriving"))
        stream = spark.readStream.schema(rows.schema).parquet(warehouse.path("arriving"))
        hours = hourly.hourly_counts(stream, "1 hour")
        hourly.start_windows(hours, warehouse.path("hours"), warehouse.path("windows")).awaitTermination()
    latest = hourly.latest_windows(hours, warehouse.path("hours"), ["station_number", "part_number", "date_hour"])
    got = {(str(r.date_hour)[:13], r.count_bookings, r.fail_bookings, str(r.sum_cycle_time)) for r in latest.collect()}
    assert got == {
        ("2025-10-25 10", 4, 2, "16.00"),
        ("2025-10-25 11", 1, 1, "4.00"),
        ("2025-10-24 23", 1, 0, "4.00"),
        ("2099-01-01 00", 1, 0, "4.00"),
    }


def test_reference_tables_keep_stations_and_update_ideal_times(spark, warehouse):
    warehouse.replace_reference("stations", warehouse.stations().withColumn("station_name", F.concat(F.lit("old "), "station_name")))
    slow = F.lit("99.00").cast("decimal(10,2)")
    warehouse.replace_reference("ideal_cycle_times", warehouse.ideal_cycle_times().withColumn("ideal_cycle_time", slow))
    warehouse.create()
    assert warehouse.stations().where("station_name not like 'old %'").isEmpty()
    assert warehouse.ideal_cycle_times().where("ideal_cycle_time = 99").isEmpty()
    assert warehouse.ideal_cycle_times().count() == 8


def test_reference_rows_that_break_a_constraint_are_refused(spark):
    rows = schemas.stations(spark)
    checks.demand(rows, "stations")
    for bad, rule in (
        (rows.union(rows.limit(1)), "unique"),
        (rows.withColumn("station_name", F.lit(None).cast("string")), "required"),
        (rows.withColumn("lane", F.repeat(F.lit("x"), 21)), "length"),
    ):
        with pytest.raises(ValueError, match=rule):
            checks.demand(bad, "stations")


def test_stored_columns_follow_the_model_and_keep_their_notes(spark, warehouse, make_bookings):
    bookings = make_bookings([("b1", "S1", "1003", "PASS", "2025-10-25T10:00:00", "P1", "4.00", 1)])
    warehouse.append_facts(bookings)
    full_refresh(warehouse)
    model = models.PERFORMANCE
    assert warehouse.notes(model.name) == model.notes
    old = warehouse.table(model.name, model.schema).withColumn("count_bookings", F.col("count_bookings").cast("int")).drop("avg_cycle_time").withColumn("gone", F.lit(1))
    warehouse.replace_table(model.name, old.cache())
    synced = warehouse.synced(model.name, model.schema)
    assert [(f.name, f.dataType) for f in synced.schema] == [(f.name, f.dataType) for f in spark.createDataFrame([], model.schema).schema]
    assert [(r.count_bookings, r.avg_cycle_time) for r in synced.collect()] == [(1, None)]
    full_refresh(warehouse)
    assert warehouse.table(model.name, model.schema).first().avg_cycle_time is not None


def test_constraint_reports(make_bookings):
    rows = make_bookings(
        [
            ("b1", "S1", "1003", "PASS", "2025-10-25T10:00:00", "P1", "1.00", 1),
            ("b1", "S1", "10030", None, "2025-10-25T10:00:00", "P1", "1.00", 1),
            ("b1", "S2", "1003", "PASS", None, "P1", "1.00", 1),
        ]
    )
    assert tuple(checks.uniqueness(rows, "t", "booking_id").first()) == ("t", "booking_id", 1, 2)
    nulls = checks.null_counts(rows, "t", ["book_state", "date_created", "part_number"])
    assert {r.column_name: r.null_count for r in nulls.collect()} == {"book_state": 1, "date_created": 1, "part_number": 0}
    widths = checks.length_violations(rows, "t", {"station_number": 4, "part_number": 2})
    assert {r.column_name: r.too_long for r in widths.collect()} == {"station_number": 1, "part_number": 0}


def test_only_bad_messages_keep_their_text(spark):
    found = topic.without_good_texts(decode(spark, message(), "no JSON")).collect()
    assert sorted((r.value, r.booking_id) for r in found if r.reason) == [("no JSON", None)]
    assert [(r.value, r.booking_id) for r in found if not r.reason] == [(None, "b01")]


def test_rows_held_while_a_batch_is_stored_are_short(spark, warehouse, monkeypatch):
    """What a batch keeps in memory are decoded rows without the texts of good messages."""
    held = []
    kept = topic.quarantined
    monkeypatch.setattr(topic, "quarantined", lambda decoded: held.append(decoded.where("reason IS NULL AND value IS NOT NULL").count()) or kept(decoded))
    Ingest(warehouse).store(spark.createDataFrame([(message(),), ("no JSON",)], "value STRING"), 0)
    assert held == [0] and ids(warehouse.facts()) == ["b01"]
    assert [r.value for r in Ingest(warehouse).quarantine().collect()] == ["no JSON"]


def test_envelope_is_compact_json_whose_schema_is_not_made_for_each_row(make_bookings):
    made = topic.envelope(make_bookings([('b"1', "S1", "1003", "PASS", "2025-10-25T10:00:00", None, "4.00", 1)]))
    types = [{"field": f.name, "type": f.dataType.simpleString()} for f in schemas.STATION_RECORDS]
    start = '{"schema":' + json.dumps({"type": "struct", "fields": types}, separators=(",", ":")) + ',"payload":{'
    assert start[:-1] in made._jdf.queryExecution().analyzed().toString()
    text = made.first()[0]
    assert text.startswith(start)
    assert json.loads(text)["payload"] == {
        **GOOD, "booking_id": 'b"1', "date_created": "2025-10-25 10:00:00", "part_number": None
    }

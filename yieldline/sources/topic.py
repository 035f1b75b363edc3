"""Booking messages: JSON with an embedded schema, `{"schema": ..., "payload": {...}}`.

Decoding never fails on a bad message. Each message becomes one row with its booking fields, the
reason why it cannot be stored (NULL if it can), and all payload fields the fact table lacks, as one map.
The schema half must be there. It decides how a value is read: decimals may be encoded as bytes and
timestamps as epoch milliseconds. For a field that it does not declare, the JSON type decides.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yieldline import schemas
from yieldline.functions.timing import from_epoch_millis
from yieldline.operators.checks import fitted, too_long

FIELDS = schemas.STATION_RECORDS.names
LENGTHS = schemas.MAX_LENGTHS["station_records"]
REQUIRED = schemas.REQUIRED["station_records"]
# Names of the connector's logical types.
DECIMAL_TYPE = "org.apache.kafka.connect.data.Decimal"
TIMESTAMP_TYPE = "org.apache.kafka.connect.data.Timestamp"
# What is kept of a bad message: as it came, where it stood in its topic, and why it is bad.
QUARANTINE = T.StructType(
    [
        *[T.StructField(c, T.StringType()) for c in ("value", "key", "topic")],
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("reason", T.StringType()),
    ]
)
MESSAGE = (
    "schema STRUCT<type STRING, fields ARRAY<STRUCT<field STRING, type STRING, name STRING, parameters MAP<STRING, STRING>>>>,"
    " payload MAP<STRING, STRING>, malformed STRING"
)


def read_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Streaming scan of a Kafka topic (needs the public spark-sql-kafka package on the cluster)."""
    stream = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return (
        stream.option("subscribe", topic)
        .options(**options)
        .load()
        .select(F.col("value").cast("string"), F.col("key").cast("string"), "topic", "partition", "offset")
    )


def read_landing(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The same messages from a folder of text files, one message per line."""
    return spark.readStream.schema("value STRING").options(**options).text(path)


def envelope(bookings: DataFrame, omit: Column | None = None) -> DataFrame:
    """Bookings as messages; `omit` says for which rows test_count is left out altogether."""
    fields = [F.col(c).cast("string").alias(c) if c == "date_created" else F.col(c) for c in bookings.columns]
    types = [{"field": f.name, "type": f.dataType.simpleString()} for f in bookings.schema]
    schema = json.dumps({"type": "struct", "fields": types}, separators=(",", ":"), ensure_ascii=False)

    def message(columns: list[Column]) -> Column:
        payload = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
        return F.concat(F.lit(f'{{"schema":{schema},"payload":'), payload, F.lit("}"))

    value = message(fields)
    if omit is not None:
        short = [c for c, name in zip(fields, bookings.columns) if name != "test_count"]
        value = F.when(omit, message(short)).otherwise(value)
    return bookings.select(value.alias("value"))


def _declared(name: str) -> Column:
    """What the message's schema says about a field."""
    return F.get(F.filter(F.col("message.schema.fields"), lambda f: f["field"] == name), F.lit(0))


def _is_number(name: str, text: Column) -> Column:
    """Whether the payload has the field as a JSON number; only digits need a second look at the message."""
    value = F.try_variant_get(F.try_parse_json("value"), f"$.payload.{name}", "variant")
    kind = F.schema_of_variant(value)
    return F.when(text.rlike("^-?[0-9]+$"), kind.startswith("BIGINT") | kind.startswith("DECIMAL")).otherwise(False)


def _timestamp(name: str, text: Column) -> Column:
    """Epoch milliseconds or an ISO timestamp; a zone suffix is ignored (local wall clock)."""
    declared = _declared(name)
    as_millis = (declared["name"] == TIMESTAMP_TYPE) | declared["type"].isin("int64", "int32")
    number = F.coalesce(as_millis, F.lit(False)) | _is_number(name, text)
    return F.when(number, from_epoch_millis(text.try_cast("bigint"))).otherwise(text.try_cast("timestamp_ntz"))


def _decimal(name: str, text: Column, kind: str) -> Column:
    """A decimal as text, or as the unscaled number in big-endian bytes (base64) with its scale in the schema."""
    declared = _declared(name)
    digits = F.hex(F.try_to_binary(text, F.lit("base64")))
    sign = F.when(F.substring(digits, 1, 1) >= "8", "F").otherwise("0")
    unscaled = F.when(
        F.length(digits).between(1, 16), F.conv(F.concat(F.repeat(sign, 16 - F.length(digits)), digits), 16, -10)
    ).try_cast("decimal(20,0)")
    scale = F.element_at(declared["parameters"], "scale").try_cast("int")
    unit = F.when(scale.between(0, 18), F.rpad(F.lit("1"), scale + 1, "0")).try_cast("decimal(19,0)")
    encoded = F.coalesce(declared["name"] == DECIMAL_TYPE, F.lit(False))
    value = F.when(encoded, F.try_divide(unscaled, unit).cast("string")).otherwise(text)
    return value.try_cast(kind)


def decode(messages: DataFrame) -> DataFrame:
    """Message rows plus booking fields, `reason` and `extras`."""
    parsed = F.from_json("value", MESSAGE, {"columnNameOfCorruptRecord": "malformed"})
    rows = messages.withColumn("message", parsed).withColumn("payload", F.col("message.payload"))
    payload = F.col("payload")
    raw = {name: F.element_at(payload, name) for name in FIELDS}
    # Columns of their own, as several others need them.
    cycle_time = _decimal("cycle_time", raw["cycle_time"], "decimal(10,2)")
    rows = rows.withColumns({"read_created": _timestamp("date_created", raw["date_created"]), "read_cycle_time": cycle_time})
    created = F.col("read_created")
    in_range = F.year(created).between(schemas.FIRST_YEAR, schemas.LAST_YEAR)
    typed = {
        **{name: fitted(raw[name], LENGTHS[name]) for name in LENGTHS},
        "date_created": F.when(in_range, created),
        "cycle_time": F.col("read_cycle_time"),
        "test_count": F.when(~F.map_contains_key(payload, "test_count"), schemas.DEFAULT_TEST_COUNT).otherwise(
            raw["test_count"].try_cast("int")
        ),
    }
    problems = [F.when(raw[c].isNull(), F.lit(f"{c} is missing")) for c in REQUIRED]
    problems += [F.when(too_long(raw[c], n), F.lit(f"{c} is longer than {n}")) for c, n in LENGTHS.items()]
    problems += [
        F.when(raw[c].isNotNull() & typed[c].isNull(), F.lit(f"{c} is not a {kind}"))
        for c, kind in (("cycle_time", "decimal(10,2)"), ("test_count", "integer"))
    ]
    dated = raw["date_created"].isNotNull()
    problems.append(F.when(dated & created.isNull(), F.lit("date_created is not a timestamp")))
    problems.append(F.when(dated & ~in_range, F.lit("date_created is out of range")))
    reason = (
        F.when(F.col("message.malformed").isNotNull(), "not a JSON message")
        .when(F.col("message.schema").isNull(), "no schema")
        .when(payload.isNull(), "no payload")
        .otherwise(F.nullif(F.concat_ws("; ", *problems), F.lit("")))
    )
    extras = F.map_filter(payload, lambda name, _: ~name.isin(FIELDS))
    return rows.select(
        *messages.columns,
        *[typed[name].alias(name) for name in FIELDS],
        reason.alias("reason"),
        extras.alias("extras"),
    )


def without_good_texts(decoded: DataFrame) -> DataFrame:
    """Only bad messages keep their text, which is many times as long as the fields: for rows that are held for several reads."""
    return decoded.withColumn("value", F.when(F.col("reason").isNotNull(), F.col("value")))


def valid(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reason").isNull())


def quarantined(decoded: DataFrame) -> DataFrame:
    """Bad messages as they came, with the reason (and their position if the source has one)."""
    keep = [c for c in decoded.columns if c not in (*FIELDS, "extras")]
    return decoded.where(F.col("reason").isNotNull()).select(*keep)

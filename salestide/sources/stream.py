"""S6-S8: multi-topic JSON messages.

A message stream is any DataFrame with ``topic`` and ``value`` columns
(string or binary) — Kafka's ``readStream`` output, or a file stream in
tests.  Each topic carries one relation as JSON objects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salestide.schemas import RELATIONS


def kafka_messages(spark: SparkSession, bootstrap_servers: str, topics: list[str],
                   starting_offsets: str = "earliest", **options) -> DataFrame:
    """Subscribe to several topics at once (needs the Kafka connector on the
    classpath).  Offsets are tracked by the query checkpoint, not by a
    consumer group, so a restart resumes exactly where the sink committed."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", ",".join(topics))
              .option("startingOffsets", starting_offsets))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load().select(
        "topic", F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"), "timestamp")


MESSAGE_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("value", T.StringType()),
])


def decode(messages: DataFrame, relation: str | None = None,
           schema: T.StructType | None = None, id_column: str | None = None,
           keep: tuple[str, ...] = ()) -> DataFrame:
    """S7: parse the JSON ``value`` into the relation's columns.  A value
    that is not a JSON object, has a field that does not parse, or lacks the
    id yields no row here; ``rejected`` gives exactly those.
    ``keep`` carries message columns along (e.g. the broker timestamp)."""
    schema, id_column = _shape(relation, schema, id_column)
    good = _parsed(messages, schema, id_column).where(F.col("_reason") == "")
    out = good.select(*[F.col(f"_r.{f.name}").alias(f.name) for f in schema.fields], *keep)
    if relation == "order_items" and "line_amount" not in out.columns:
        out = out.withColumn("line_amount", F.col("quantity") * F.col("unit_price"))
    return out


_CORRUPT = "_corrupt_record"


def _shape(relation, schema, id_column):
    if schema is None:
        schema, default_id = RELATIONS[relation]
        id_column = id_column or default_id
    return schema, id_column


def _parsed(messages: DataFrame, schema: T.StructType, id_column: str | None) -> DataFrame:
    """``messages`` with the parsed ``_r`` and ``_reason`` ('' for a good one)."""
    text = F.col("value").cast("string")
    wide = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    out = messages.withColumn("_r", F.from_json(
        text, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}))
    bad = F.col("_r").isNull() | F.col(f"_r.{_CORRUPT}").isNotNull()
    reason = F.when(bad, F.lit("malformed"))
    if id_column:
        reason = reason.when(F.col(f"_r.{id_column}").isNull(), F.lit(f"no {id_column}"))
    return out.withColumn("_reason", reason.otherwise(F.lit("")))


def rejected(messages: DataFrame, relation: str | None = None, schema: T.StructType | None = None,
             id_column: str | None = None) -> DataFrame:
    """The messages that ``decode`` leaves out: (topic, value, reason)."""
    schema, id_column = _shape(relation, schema, id_column)
    return _parsed(messages, schema, id_column).where(F.col("_reason") != "").select(
        "topic", F.col("value").cast("string").alias("value"), F.col("_reason").alias("reason"))


LANDED = "body"


def land(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The messages with their whole JSON value as a VARIANT column ``body``
    (topic, body, value, kept columns).  Fields that no schema names stay
    readable (``landed_field``) without a replay; a value that is not JSON has
    a null ``body`` and keeps its text in ``value``."""
    text = F.col("value").cast("string")
    body = F.try_parse_json(text)
    return messages.select("topic", body.alias(LANDED), F.when(body.isNull(), text).alias("value"), *keep)


def landed_field(path: str, kind: str) -> Column:
    """One field of landed messages, e.g. ``landed_field("$.coupon.code",
    "string")``; null where it is absent or of another kind."""
    return F.try_variant_get(F.col(LANDED), path, kind)


def extract(landed: DataFrame, relation: str | None = None, schema: T.StructType | None = None,
            id_column: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The relation's columns of landed messages, like ``decode``: rows
    without the id, or with a field that is there but doesn't parse, are left
    out.  ``keep`` carries columns along (``body`` itself, for later fields)."""
    schema, id_column = _shape(relation, schema, id_column)
    fields, broken = [], F.lit(False)
    for f in schema.fields:
        # times come as text: cast as the JSON reader does
        timed = isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType, T.DateType))
        text = landed_field(f"$.{f.name}", "string")
        value = text.try_cast(f.dataType) if timed else landed_field(f"$.{f.name}", f.dataType.simpleString())
        fields.append(value.alias(f.name))
        there = F.try_variant_get(F.col(LANDED), f"$.{f.name}", "variant")
        broken = broken | (value.isNull() & there.isNotNull() & ~F.coalesce(F.is_variant_null(there), F.lit(True)))
    out = landed.where(F.col(LANDED).isNotNull() & ~broken).select(*fields, *keep)
    if id_column:
        out = out.where(F.col(id_column).isNotNull())
    if relation == "order_items" and "line_amount" not in out.columns:
        out = out.withColumn("line_amount", F.col("quantity") * F.col("unit_price"))
    return out


def route(messages: DataFrame, topics: dict[str, str],
          schemas: dict[str, T.StructType] | None = None,
          keep: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """S8: one decoded DataFrame per topic (``topics`` maps topic -> relation).
    ``keep`` carries message columns into every relation (e.g. the broker
    ``timestamp``, the event time of item messages that have none)."""
    schemas = schemas or {}
    out = {}
    for topic, relation in topics.items():
        part = messages.where(F.col("topic") == topic)
        sch = schemas.get(relation)
        out[relation] = decode(part, relation, schema=sch,
                               id_column=RELATIONS[relation][1] if sch is not None else None,
                               keep=keep)
    return out


def to_messages(df: DataFrame, topic: str) -> DataFrame:
    """Encode a relation as (topic, value) JSON messages, the shape the
    producer publishes."""
    return df.select(F.lit(topic).alias("topic"),
                     F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))

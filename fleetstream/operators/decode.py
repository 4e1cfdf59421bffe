"""Raw messages to typed events, with two levels of strictness.

Messages carry the event JSON in ``value``.  A plain message, one flat object whose fields
all have their expected types, is read with a typed schema.  Everything else is parsed into
a VARIANT, which keeps absent, null, number and text apart, and judged field by field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetstream.functions.rows import computed_once
from fleetstream.functions.scalars import excerpt
from fleetstream.schemas import EVENT_FIELDS

# Largest |t_emit| in ms that fits a microsecond timestamp.
T_EMIT_LIMIT_MS = 9.0e15
INVALID_JSON = "invalid json"
MISSING_REQUIRED = "missing required fields"
BAD_FIELD = "field does not fit its column"

STRICT_FIELDS = {
    "t_emit": "bigint",
    "engineTemperature": "float",
    "tyresSurfaceTemperature": "float",
}
MISFIT = "misfit"
TYPED = "__typed_"


def typed_name(name: str) -> str:
    return TYPED + name


def typed(name: str) -> Column:
    return F.col(typed_name(name))


def is_helper(column: str) -> bool:
    return column in ("is_plain", "event") or column.startswith(TYPED)


def read_json(df: DataFrame, text: str, fields: dict[str, str], plain: Column) -> DataFrame:
    """Add the typed fields, ``is_plain`` and, for messages that are not plain, ``event``.

    The fields read with a schema are columns named by ``typed``; ``plain`` is a further
    condition on them.  ``event`` is the message as VARIANT, null unless the whole text
    is one JSON value.
    """
    schema = ", ".join(f"`{name}` {kind}" for name, kind in fields.items())
    record = F.from_json(
        text, f"{schema}, `{MISFIT}` string", {"columnNameOfCorruptRecord": MISFIT}
    )
    names = [typed_name(name) for name in (*fields, MISFIT)]
    read = df.select("*", F.inline(F.array(record)).alias(*names))
    # One opening brace, and one closing brace at the end: flat, with nothing behind it.
    flat = F.col(text).rlike(r"^\s*\{[^{}]*\}\s*$")
    is_plain = flat & typed(MISFIT).isNull() & plain
    marked = computed_once(read, {"is_plain": F.coalesce(is_plain, F.lit(False))})
    return with_variant(marked, text, "event", ~F.col("is_plain"))


def with_variant(df: DataFrame, text: str, name: str, wanted: Column) -> DataFrame:
    """Add the VARIANT of the wanted texts, null unless the whole text is one JSON value.

    The parser stops after the first value, so the text is parsed as the first element
    of an array that ends with a hash of it: trailing text breaks the array or pushes
    the hash out of place.
    """
    seal = F.xxhash64(text)
    framed = F.concat(F.lit("["), F.col(text), F.lit(","), seal.cast("string"), F.lit("]"))
    once = computed_once(df, {"__framed": F.when(wanted, F.try_parse_json(framed))})
    sealed = F.try_variant_get("__framed", "$[1]", "bigint") == seal
    value = F.when(wanted & sealed, F.variant_get("__framed", "$[0]", "variant"))
    return computed_once(once, {name: value}, keep=df.columns)


def field_type(event: Column, name: str) -> Column:
    """Type name of a field; null when it is absent, ``VOID`` for JSON null."""
    return F.schema_of_variant(F.variant_get(event, f"$.{name}", "variant"))


def is_number(type_name: Column) -> Column:
    return type_name.isin("BIGINT", "DOUBLE", "FLOAT") | type_name.startswith("DECIMAL")


def with_text(messages: DataFrame) -> DataFrame:
    return messages.withColumn("payload", F.col("value").cast("string")).drop("key", "value")


def classified(messages: DataFrame) -> DataFrame:
    """Messages with their typed event fields and ``reject_reason`` (null when valid).

    Valid: one JSON object whose ``t_emit`` is a number and ``device_id`` a string.
    Other fields may be missing; ``replica`` then is 0.  A field that is present but
    does not fit its column rejects the message.
    """
    fields = EVENT_FIELDS | {"t_emit": "double"}
    payload, event = F.col("payload"), F.col("event")
    # A schema reads a number as text too, so the text itself must show the quote.
    device_text = (F.regexp_count(payload, F.lit('"device_id"')) == 1) & payload.rlike(
        r'"device_id"\s*:\s*"'
    )
    in_range = F.abs(typed("t_emit")) <= T_EMIT_LIMIT_MS
    plain = in_range & typed("device_id").isNotNull() & device_text
    read = read_json(with_text(messages), "payload", fields, plain)

    is_plain = F.col("is_plain")
    values = {
        name: F.when(is_plain, typed(name)).otherwise(
            F.try_variant_get(event, f"$.{name}", kind)
        )
        for name, kind in fields.items()
    }
    misfit = F.lit(False)
    for name, kind in fields.items():
        if name not in ("t_emit", "device_id"):
            raw = F.variant_get(event, f"$.{name}", "variant")
            fits = F.try_variant_get(event, f"$.{name}", kind).isNotNull()
            misfit = misfit | (raw.isNotNull() & ~F.is_variant_null(raw) & ~fits)
    has_time = F.coalesce(is_number(field_type(event, "t_emit")), F.lit(False))
    has_device = F.coalesce(field_type(event, "device_id") == "STRING", F.lit(False))
    time_fits = F.coalesce(
        F.abs(F.try_variant_get(event, "$.t_emit", "double")) <= T_EMIT_LIMIT_MS, F.lit(False)
    )
    reason = (
        F.when(is_plain, F.lit(None).cast("string"))
        .when(event.isNull(), INVALID_JSON)
        .when(~has_time | ~has_device, MISSING_REQUIRED)
        .when(misfit | ~time_fits, BAD_FIELD)
    )
    judged = computed_once(
        read,
        values | {"reject_reason": reason},
        keep=[c for c in read.columns if not is_helper(c)],
    )
    time = F.when(F.col("reject_reason").isNull(), F.col("t_emit"))
    return judged.withColumns(
        {
            "replica": F.coalesce("replica", F.lit(0)),
            "ts": F.timestamp_micros(F.round(time * 1000).cast("bigint")),
            "t_emit": F.floor(time).cast("bigint"),
        }
    )


def accepted(classified_messages: DataFrame) -> DataFrame:
    """Valid events: typed fields, ``ts`` and the whole event as ``payload`` JSON."""
    return classified_messages.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(classified_messages: DataFrame) -> DataFrame:
    """Rejected messages with the reason and the start of their text."""
    return classified_messages.where(F.col("reject_reason").isNotNull()).select(
        *(c for c in classified_messages.columns if c in ("topic", "partition", "offset", "seq")),
        "reject_reason",
        excerpt(F.col("payload")).alias("excerpt"),
    )


def decode_strict(messages: DataFrame) -> DataFrame:
    """Events as the window analysis reads them: ``t_emit`` and two temperatures.

    ``t_emit`` must be a whole number.  An absent temperature is 0; one that is present
    but not a number drops the event.
    """
    temperatures = [name for name in STRICT_FIELDS if name != "t_emit"]
    plain = typed("t_emit").isNotNull()
    for name in temperatures:
        # Null may mean absent or null, and non-finite values may come from text.
        plain = plain & (F.abs(typed(name)) < F.lit(float("inf")))
    read = read_json(with_text(messages), "payload", STRICT_FIELDS, plain)

    event, is_plain = F.col("event"), F.col("is_plain")
    valid = F.coalesce(field_type(event, "t_emit") == "BIGINT", F.lit(False))
    for name in temperatures:
        kind = field_type(event, name)
        valid = valid & (kind.isNull() | is_number(kind))
    values = {}
    for name, kind in STRICT_FIELDS.items():
        other = F.try_variant_get(event, f"$.{name}", kind)
        if name != "t_emit":
            other = F.coalesce(other, F.lit(0.0).cast("float"))
        values[name] = F.when(is_plain, typed(name)).otherwise(other)
    judged = computed_once(
        read,
        values | {"__valid": is_plain | valid},
        keep=[c for c in read.columns if not is_helper(c) and c != "payload"],
    )
    return judged.where("__valid").drop("__valid")

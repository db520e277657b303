"""Contract checks on JSON payloads, with a valid and a dead-letter side.

One pass over the text gives a struct of the fields as VARIANT leaves, which tell a missing field
from an explicit null and keep the JSON type, so that `"amount": "7.5"` passes while `"user_id": 77`
does not. One boolean says whether a row is valid; reasons are put together for the others alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.functions import compact
from tollgate.schemas import DEFAULTS, NUMBER_FIELDS, TEXT_FIELDS, TXN_COLUMNS, TXN_SCHEMA

# Topic names.
RAW_TOPIC = "transactions.raw"
DEAD_LETTER_TOPIC = "deadletter.transactions"
ALERT_TOPIC = "fraud.alerts"

BOUNDS = {"latitude": 90.0, "longitude": 180.0}
# ISO date, optionally followed by a time; keeps out forms only Spark would accept ("2024")
_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}:[^,]+)?$"
# ... and the shorter spellings of ISO-8601: no dashes or colons, hours alone, offsets without a colon
_SHORT_ISO = r"^\d{4}-?\d{2}-?\d{2}([T ]\d{2}(:?\d{2}(:?\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
# a number as text; keeps out the suffixes that only a cast would accept ("7.5d")
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def parse_events(raw: DataFrame) -> DataFrame:
    """`value` (text or binary JSON) to the 15 typed columns; unreadable parts become null."""
    parsed = F.from_json(F.col("value").cast("string"), TXN_SCHEMA)
    return raw.select(parsed.alias("data")).select("data.*")


def _spelled_out(text: Column) -> Column:
    """A short ISO-8601 time in the long spelling."""
    for pattern, long in (
        (r"^(\d{4})(\d{2})(\d{2})", "$1-$2-$3"),
        (r"([T ]\d{2})(\d{2})", "$1:$2"),
        (r"([T ]\d{2}:\d{2})(\d{2})", "$1:$2"),
        (r"([T ]\d{2})(Z|[+-]|$)", "$1:00$2"),
        (r"([T ]\d{2}:\d{2})(Z|[+-]|$)", "$1:00$2"),
        (r"(:\d{2}),(\d)", "$1.$2"),
        (r"(:\d{2}(?:\.\d+)?[+-]\d{2})(\d{2})$", "$1:$2"),
        (r"(:\d{2}(?:\.\d+)?[+-]\d{2})$", "$1:00"),
    ):
        text = F.regexp_replace(text, pattern, long)
    return text


def _kind(field: str) -> Column:
    return F.col(f"_kind_{field}")


def _value(field: str) -> Column:
    return F.col(f"_value_{field}")


def _problem(field: str, failed: Column, text: str) -> Column:
    return F.when(failed, F.lit(f"{field}: {text}"))


def _field_problems(field: str) -> list[Column]:
    kind = _kind(field)
    missing = F.lit(False) if field in DEFAULTS else kind.isNull()
    problems = [_problem(field, missing, "field required"), _problem(field, kind == "VOID", "must not be null")]
    present = kind.isNotNull() & (kind != "VOID")
    if field in TEXT_FIELDS:
        problems.append(_problem(field, present & (kind != "STRING"), "must be a string"))
    elif field in NUMBER_FIELDS:
        value = _value(field)
        usable = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
        problems.append(_problem(field, present & ~usable, "must be a finite number"))
        if field == "amount":
            problems.append(_problem(field, usable & (value < 0), "must be >= 0"))
        else:
            bound = BOUNDS[field]
            problems.append(_problem(field, usable & (F.abs(value) > bound), f"must be within +-{bound:g}"))
    else:
        problems.append(_problem(field, present & _value("event_time").isNull(), "must be an ISO-8601 time"))
    return problems


def _is_good(field: str) -> Column:
    """Whether a field has no problem; the same conditions as `_field_problems`, in one boolean that is never null."""
    if field in TEXT_FIELDS:
        text = F.coalesce(_kind(field) == "STRING", F.lit(False))
        return text | _kind(field).isNull() if field in DEFAULTS else text
    value = _value(field)
    if field in NUMBER_FIELDS:
        low, high = (0.0, float("inf")) if field == "amount" else (-BOUNDS[field], BOUNDS[field])
        # NaN is greater than all numbers
        return F.coalesce((value >= low) & ((value < high) if field == "amount" else (value <= high)), F.lit(False))
    return value.isNotNull()


def check_events(raw: DataFrame) -> DataFrame:
    """Add the typed contract columns and `errors`, an array that is empty for valid rows.

    Columns of `raw` other than `value` (topic, partition, offset, ...) are kept.
    """
    payload = F.col("value").cast("string")
    leaves = ", ".join(f"{field} variant" for field in TXN_COLUMNS) + ", _corrupt string"
    options = {"columnNameOfCorruptRecord": "_corrupt", "allowNonNumericNumbers": "false"}
    document = F.from_json(F.when(F.ltrim(payload).startswith("{"), payload), leaves, options)
    # `inline` keeps a filter on the errors from being pushed down through the parsing,
    # which would repeat it for every mention of every field.
    parsed = raw.select("*", F.inline(F.array(F.struct(document.alias("_json")))))

    fields = [(F.col("_json").isNotNull() & F.col("_json._corrupt").isNull()).alias("_readable")]
    for field in TXN_COLUMNS:
        leaf = F.col(f"_json.{field}")
        kind = F.schema_of_variant(leaf)
        fields.append(kind.alias(f"_kind_{field}"))
        text = F.try_variant_get(leaf, "$", "string")
        if field in NUMBER_FIELDS:
            usable = (kind != "STRING") | text.rlike(_NUMBER)
            value = F.when(usable, F.try_variant_get(leaf, "$", "double"))
        elif field == "event_time":
            value = F.try_to_timestamp(F.when(text.rlike(_ISO), text).when(text.rlike(_SHORT_ISO), _spelled_out(text)))
        else:
            value = F.coalesce(text, F.lit(DEFAULTS[field])) if field in DEFAULTS else text
        fields.append(value.alias(f"_value_{field}"))
    typed = parsed.select(*raw.columns, F.inline(F.array(F.struct(*fields))))

    good = F.lit(True)
    for field in TXN_COLUMNS:
        good = good & _is_good(field)
    problems = [p for field in TXN_COLUMNS for p in _field_problems(field)]
    unreadable = F.array(F.lit("payload: not a JSON object"))
    errors = F.when(~F.col("_readable"), unreadable).when(good, F.array().cast("array<string>")).otherwise(compact(*problems))
    return typed.select(*raw.columns, errors.alias("errors"), *[_value(f).alias(f) for f in TXN_COLUMNS])


def valid_events(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("errors") == 0).select(*TXN_COLUMNS)


def dead_letters(checked: DataFrame, source_topic: str = RAW_TOPIC) -> DataFrame:
    """Failed payloads with the reason; partition and offset too when the source has them."""
    place = [c for c in ("partition", "offset", "timestamp") if c in checked.columns]
    return checked.filter(F.size("errors") > 0).select(
        F.col("value").cast("string").alias("raw_payload"),
        F.array_join("errors", "; ").alias("error_message"),
        F.element_at(F.split(F.element_at("errors", 1), ": "), 1).alias("error_type"),
        F.lit(source_topic).alias("source_topic"),
        *place,
    )

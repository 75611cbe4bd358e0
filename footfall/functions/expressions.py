"""Column expressions for times, numbers, delimited strings and JSON. All run inside the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str

# The text formats of the logs.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIME_INPUT_FORMAT = "yyyy-MM-dd H:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
DATE_KEY_FORMAT = "yyyyMMdd"
DATE_HOUR_FORMAT = "yyyy-MM-dd_HH"
MINUTE_FORMAT = "yyyyMMddHHmm"


def _col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- times ---------------------------------------------------------------------------------

def parse_time(value: ColumnOrName) -> Column:
    """Text to timestamp; ``9:05:06`` and ``09:05:06`` both parse, anything else gives null."""
    return F.try_to_timestamp(_col(value), F.lit(TIME_INPUT_FORMAT)).cast("timestamp_ntz")


def format_time(value: ColumnOrName) -> Column:
    return F.date_format(value, TIME_FORMAT)


def format_date(value: ColumnOrName) -> Column:
    return F.date_format(value, DATE_FORMAT)


def format_minute(value: ColumnOrName) -> Column:
    return F.date_format(value, MINUTE_FORMAT)


def date_key(value: ColumnOrName) -> Column:
    return F.date_format(value, DATE_KEY_FORMAT)


def parse_date_key(value: ColumnOrName) -> Column:
    return F.to_date(value, DATE_KEY_FORMAT)


def date_hour(value: ColumnOrName) -> Column:
    return F.date_format(value, DATE_HOUR_FORMAT)


def seconds_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole seconds from ``start`` to ``end``."""
    return F.timestamp_diff("SECOND", _col(start), _col(end))


def is_before(left: ColumnOrName, right: ColumnOrName) -> Column:
    return _col(left) < _col(right)


def is_after(left: ColumnOrName, right: ColumnOrName) -> Column:
    return _col(left) > _col(right)


def today() -> Column:
    return format_date(F.current_date())


def yesterday() -> Column:
    return format_date(F.date_sub(F.current_date(), 1))


def epoch_millis_to_time(value: ColumnOrName) -> Column:
    """Epoch milliseconds as UTC wall time, whatever the session time zone."""
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + _col(value) * F.expr("INTERVAL '0.001' SECOND")


# --- numbers -------------------------------------------------------------------------------

def half_up(value: ColumnOrName, scale: int) -> Column:
    return F.round(_col(value), scale)


def ratio_2dp(part: ColumnOrName, whole: ColumnOrName) -> Column:
    """``part / whole`` to two places, halves up, worked out in whole numbers so it is exact."""
    part, whole = _col(part), _col(whole)
    scaled, unit = part * 200 + whole, whole * 2
    hundredths = (scaled - scaled % unit) / unit
    return F.when(whole > 0, hundredths / F.lit(100.0))


# --- strings -------------------------------------------------------------------------------

def is_empty(value: ColumnOrName) -> Column:
    return _col(value).isNull() | (_col(value) == "")


def trim_commas(value: ColumnOrName) -> Column:
    return F.btrim(_col(value), F.lit(","))


def zero_pad_2(value: ColumnOrName) -> Column:
    """Left-pad to two digits; longer text stays whole."""
    text = _col(value).cast("string")
    return F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)


def split_ids(value: ColumnOrName) -> Column:
    """Comma-joined ids as an array of bigint; null gives an empty array, blanks are dropped."""
    ids = F.transform(F.split(_col(value), ","), lambda item: item.try_cast("bigint"))
    return F.coalesce(F.filter(ids, lambda item: item.isNotNull()), F.array().cast("array<bigint>"))


def join_sorted(items: ColumnOrName) -> Column:
    """An array as one comma-joined string in ascending order; null if there is nothing."""
    return F.nullif(F.array_join(F.array_sort(_col(items)).cast("array<string>"), ","), F.lit(""))


def kv_record(**fields: Column) -> Column:
    """Named values as ``name=value|name=value``; nulls are written as nothing."""
    parts = [
        F.concat(F.lit(f"{name}="), F.coalesce(value.cast("string"), F.lit("")))
        for name, value in fields.items()
    ]
    return F.concat_ws("|", *parts)


def kv_get(record: ColumnOrName, field: str) -> Column:
    """The value of a field in ``name=value|name=value``; null if absent or empty."""
    pattern = rf"(?:^|\|){re.escape(field)}=([^|]*)"
    return F.nullif(F.regexp_extract(_col(record), pattern, 1), F.lit(""))


def kv_set(record: ColumnOrName, field: str, value: Column) -> Column:
    """Replace the value of a field that is there; a record without it is unchanged."""
    def replaced(part: Column) -> Column:
        is_field = F.substring_index(part, "=", 1) == field
        return F.when(is_field, F.concat(F.lit(f"{field}="), value)).otherwise(part)

    return F.array_join(F.transform(F.split(_col(record), r"\|"), replaced), "|")


def concat_long_string(number: ColumnOrName, text: ColumnOrName, separator: str) -> Column:
    return F.concat(_col(number).cast("string"), F.lit(separator), _col(text))


# --- json ----------------------------------------------------------------------------------

def json_field(document: ColumnOrName, field: str) -> Column:
    return F.get_json_object(document, f"$.{field}")


def product_status(extend_info: ColumnOrName) -> Column:
    """``Self`` for status 0, ``Third Party`` for any other or missing status."""
    own = json_field(extend_info, "product_status") == "0"
    return F.when(own, "Self").otherwise("Third Party")


# --- aggregates ----------------------------------------------------------------------------

def group_concat_distinct(value: ColumnOrName) -> Column:
    """Distinct values, comma-joined in ascending order."""
    return join_sorted(F.collect_set(_col(value)))


def user_avg(value: ColumnOrName) -> Column:
    """Sum over count as a double. Partial sums are merged, so a hot group costs one row a task."""
    return F.try_divide(F.sum(_col(value)).cast("double"), F.count(_col(value)))

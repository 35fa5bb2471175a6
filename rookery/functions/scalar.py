"""Small column expressions: names, keys, hashes, dates and time stamps."""

from pyspark.sql import Column, functions as F

# The marker an account carries in place of an empty set, and the
# separator of conversation keys.
EMPTY_MARKER = "none"
KEY_SEPARATOR = "__"

MILLIS_PER_DAY = 86_400_000


def capitalize_name(name: Column) -> Column:
    """First character upper, all others lower (not word by word)."""
    return F.concat(F.upper(F.substring(name, 1, 1)), F.lower(F.substr(name, F.lit(2))))


def full_name(first: Column, last: Column) -> Column:
    return F.concat_ws(" ", first, last)


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


def post_id(ts_ms: Column, username: Column) -> Column:
    return F.concat_ws("-", ts_ms.cast("string"), username)


def conversation_key(*names: Column) -> Column:
    """Sorted participant names joined by the key separator."""
    return member_key(F.array(*names))


def member_key(members: Column) -> Column:
    return F.array_join(F.array_sort(members), KEY_SEPARATOR)


def clean_link(link: Column) -> Column:
    return F.regexp_replace(link, r"\s", "")


def as_set(values: Column) -> Column:
    """Canonical set: null becomes empty, the empty marker goes, duplicates go."""
    present = F.coalesce(values, F.array().cast("array<string>"))
    return F.array_distinct(F.array_remove(present, EMPTY_MARKER))


def publish_date(text: Column, shift_months: int = 48) -> Column:
    """``yyyy-MM-dd`` text to a date, moved by whole months; bad text gives null."""
    return F.add_months(F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date"), shift_months)


def wall_clock_ms(ts_ntz: Column) -> Column:
    """Epoch milliseconds of a zone-less time stamp, independent of the session zone."""
    gap = ts_ntz - F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return (
        F.extract(F.lit("DAY"), gap).cast("bigint") * MILLIS_PER_DAY
        + F.extract(F.lit("HOUR"), gap).cast("bigint") * 3_600_000
        + F.extract(F.lit("MINUTE"), gap).cast("bigint") * 60_000
        + F.floor(F.extract(F.lit("SECOND"), gap) * 1000).cast("bigint")
    )


def display_time(ts_ms: Column) -> Column:
    """Epoch milliseconds as shown on a page, in fixed UTC-5 time."""
    whole_seconds = F.floor(ts_ms.cast("bigint") / 1000).cast("bigint") - 5 * 3600
    local = F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), whole_seconds.cast("decimal(18,6)")
    )
    return F.date_format(local, "M/d/yyyy, h:mm:ss a")


def hash_uniform(*parts: Column, seed: int = 0) -> Column:
    """A reproducible draw from [0, 1) that depends on the parts and the seed only."""
    digest = F.md5(F.concat_ws("|", *parts, F.lit(str(seed))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)

"""Date parsing as column expressions (no per-row Python)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folio.functions.text import let

# ISO-8601 shapes accepted by Python's datetime.fromisoformat (3.11+),
# tried in order.
ISO_PATTERNS = [
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
    "yyyy-MM-dd'T'HH:mm:ss.SSS", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mmXXX",
    "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd", "yyyyMMdd",
]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_iso8601(c) -> Column:
    """First ISO-8601 shape that parses, as TIMESTAMP (null when none does)."""
    s = _col(c)
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(p)) for p in ISO_PATTERNS])


def validate_iso8601(c) -> Column:
    """True when the text is an ISO-8601 date/time."""
    return parse_iso8601(c).isNotNull()


# Other shapes of dates in documents, tried in this order once a weekday and a zone are off
DIGIT_PATTERNS = {14: "yyyyMMddHHmmss", 12: "yyyyMMddHHmm", 10: "yyyyMMddHH", 8: "yyyyMMdd", 4: "yyyy"}
LOOSE_PATTERNS = [
    "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd HH:mm", "yyyy-MM-dd", "yyyy-MM",
    "yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd", "M/d/yyyy h:mm:ss a", "M/d/yyyy HH:mm:ss", "M/d/yyyy HH:mm", "M/d/yyyy", "MMM d HH:mm:ss yyyy", "MMM d yyyy HH:mm:ss", "MMM d yyyy",
    "MMMM d yyyy HH:mm:ss", "MMMM d yyyy", "d MMM yyyy HH:mm:ss", "d MMM yyyy HH:mm", "d MMM yyyy", "d MMMM yyyy HH:mm:ss", "d MMMM yyyy"]
_WEEKDAY = "(?i)^(mon|tue|wed|thu|fri|sat|sun)[a-z]*[,.]?\\s+"
_ZONE = "(?i)(?:\\s*(?:utc|gmt))?\\s*([+-]\\d{2}):?(\\d{2})$"


def parse_pdf_date(c, keep_tz: bool = False) -> Column:
    """PDF metadata date ``D:YYYYMMDDHHmmSS+HH'mm'`` -> ISO text.

    Default: converted to UTC and printed without a zone (``2021-12-22T21:11:31``); ``keep_tz`` keeps the
    local time and prints the offset. Other shapes (shortened PDF dates, ISO, dates with month names,
    weekdays or slashes; month before day) are tried where that one does not fit; without a zone the
    time is taken as it stands. Unparseable -> null (the caller decides; the reference
    substitutes "now", which is not reproducible)."""
    # D:20211222141131-07'00'  ->  20211222141131-0700
    cleaned = F.replace(F.regexp_replace(F.trim(_col(c)), "^D:", ""), F.lit("'"), F.lit(""))
    cleaned = F.regexp_replace(cleaned, "(?i)(?<=\\d)\\s*(z|utc|gmt)(00:?00)?$", "+0000")

    def split(d: Column) -> Column:
        zoned = d.rlike("\\d{1,2}:\\d{2}(:\\d{2}([.]\\d+)?)?(\\s*[ap]m)?" + _ZONE[4:]) | d.rlike("^\\d{10,14}[+-]\\d{2}:?\\d{2}$")
        local = F.regexp_replace(F.when(zoned, F.regexp_replace(d, _ZONE, "")).otherwise(d), "[.]\\d+$", "")
        plain = F.replace(F.regexp_replace(F.regexp_replace(local, _WEEKDAY, ""), "(?i)(?<=[0-9])(st|nd|rd|th)(?= )", ""), F.lit(","), F.lit(" "))
        return F.struct(F.when(local.rlike("^\\d+$"), local).otherwise(F.regexp_replace(plain, "\\s+", " ")).alias("local"),
                        F.when(zoned, F.regexp_extract(d, _ZONE, 1)).alias("hours"), F.when(zoned, F.regexp_extract(d, _ZONE, 2)).alias("mins"))

    def read(p: Column) -> Column:
        digits = p["local"].rlike("^\\d+$")
        ts = F.when(~digits, F.coalesce(*[F.try_to_timestamp(p["local"], F.lit(x)).cast("timestamp_ntz") for x in LOOSE_PATTERNS]))
        for size, x in DIGIT_PATTERNS.items():
            ts = F.when(digits & (F.length(p["local"]) == size), F.try_to_timestamp(p["local"], F.lit(x)).cast("timestamp_ntz")).otherwise(ts)
        return F.struct(ts.alias("ts"), p["hours"].alias("hours"), p["mins"].alias("mins"))

    def write(p: Column) -> Column:
        local = F.date_format(p["ts"], "yyyy-MM-dd'T'HH:mm:ss")
        if keep_tz:
            return F.when(p["hours"].isNotNull(), F.concat(local, p["hours"], F.lit(":"), p["mins"])).otherwise(local)
        minutes = F.when(p["hours"].startswith("-"), -1).otherwise(1) * (F.substring(p["hours"], 2, 2).try_cast("int") * 60 + p["mins"].try_cast("int"))
        return F.coalesce(F.date_format(F.timestamp_add("MINUTE", -minutes, p["ts"]), "yyyy-MM-dd'T'HH:mm:ss"), local)

    return let(cleaned, lambda d: let(split(d), lambda p: let(read(p), write)))  # each step once a row

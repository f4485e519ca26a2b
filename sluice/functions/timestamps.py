"""Timestamps in event records: parsing, repair, bounds.  Sessions run in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.jsonpath import bound

_ISO = r"^\d{4}-\d\d-\d\d[Tt ]\d\d:\d\d:[0-5]\d(\.\d+)?([Zz]|[+-]\d\d(:?\d\d)?)?$"
#: Formats without a zone that are read as UTC when the strict form fails.
NAIVE = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm", "yyyy/MM/dd HH:mm:ss", "dd/MMM/yyyy:HH:mm:ss", "MM/dd/yyyy HH:mm:ss", "yyyyMMddHHmmss")


def parse_iso(text: Column) -> Column:
    """A full date and time with optional fraction and zone (none: UTC), else null.
    Digits past the sixth are dropped."""
    return F.when(text.rlike(_ISO), F.upper(text).try_cast("timestamp"))


def utc_text(ts: Column) -> Column:
    """ISO text ending in Z with 3 digits of a second, or 6 where they are needed."""
    long = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.when(F.substring(long, 24, 3) == "000", F.substring(long, 1, 23)).otherwise(long), F.lit("Z"))


def normalise_zoned(text: Column) -> Column:
    """Zoned ISO text as UTC text; any other text as it is."""
    zoned = text.rlike(r"^\d{4}-\d\d-\d\d[Tt ].*([Zz]|[+-]\d\d(:?\d\d)?)$")
    return F.coalesce(F.when(zoned, utc_text(parse_iso(text))), text)


def from_epoch(number: Column) -> Column:
    """A whole number as nano-, micro-, milli- or plain seconds, by its magnitude."""
    n = number.cast("long")
    size = F.abs(n)
    micros = F.when(size > 10**18, F.floor(n.cast("decimal(20,0)") / 1000)).when(size > 10**15, n).when(size > 10**12, n * 1000).otherwise(n * 1_000_000)
    return F.timestamp_micros(micros.cast("long"))


def epoch_of(text: Column) -> Column:
    """A number as text: a whole one by its magnitude, one with a fraction as seconds."""
    whole = bound(text.try_cast("long"), from_epoch)
    return F.when(text.rlike(r"^-?\d{1,19}$"), whole).when(text.rlike(r"^-?\d{1,12}\.\d+$"), F.timestamp_seconds(text.try_cast("decimal(24,6)")))


def from_unix(number: Column) -> Column:
    """A whole number as milliseconds above 10**12, else as seconds."""
    return F.when(number > 10**12, F.timestamp_millis(number.cast("long"))).otherwise(F.timestamp_seconds(number))


def lenient(text: Column) -> Column:
    """ISO text, then the formats without zone."""
    return F.coalesce(parse_iso(text), *[F.try_to_timestamp(text, F.lit(f)) for f in NAIVE])


def repaired(text: Column) -> Column:
    """Digits alone as an epoch: above 10**12 milliseconds, above 10**9 seconds."""
    return F.when(text.rlike(r"^\d{1,18}$"), bound(text.try_cast("long"), lambda n: F.when(n > 10**12, F.timestamp_millis(n)).when(n > 10**9, F.timestamp_seconds(n))))


def within(ts: Column, now: Column, future: int, past: int) -> Column:
    """Whether a timestamp is believable at ``now``, on whole seconds."""
    ahead = F.unix_seconds(ts) - F.unix_seconds(now)
    return ~(ahead > future) & (F.lit(True) if past == 0 else ~(-ahead > past))


def believed(parsed: Column, text: Column, now: Column, future: int, past: int) -> Column:
    """struct(ts, quality) of a value that was parsed (or null): ``valid``, ``corrected``
    for a repaired one (which is not held to the bounds), or ``replaced`` by ``now``."""
    good = F.when(parsed.isNotNull() & within(parsed, now, future, past), parsed)
    fixed = F.when(parsed.isNull(), repaired(text))
    return bound(
        F.struct(good.alias("good"), fixed.alias("fixed")),
        lambda x: F.struct(F.coalesce(x["good"], x["fixed"], now).alias("ts"), F.when(x["good"].isNotNull(), "valid").when(x["fixed"].isNotNull(), "corrected").otherwise("replaced").alias("quality")),
    )


def checked(text: Column, number: Column, now: Column, future: int, past: int) -> Column:
    """``believed`` of text, or else of a number."""
    return bound(F.coalesce(lenient(text), from_epoch(number)), lambda p: believed(p, text, now, future, past))


def clamped(ts: Column, low: str = "1900-01-01", high: str = "2299-12-31 23:59:59.999") -> Column:
    """A timestamp held between two bounds."""
    return F.least(F.greatest(ts, F.lit(low).cast("timestamp")), F.lit(high).cast("timestamp"))


# Nanoseconds: Spark's own timestamps end at microseconds, so these are struct(seconds, nanos)

#: Formats without T that are read when the strict form fails; those in ``_ZONED`` end in an
#: offset such as +01:00 (fixed list).
_ZONED = ("yyyy-MM-dd HH:mm:ssXXX", "dd/MMM/yyyy:HH:mm:ss XX", "yyyy/MM/dd HH:mm:ss XXX")
_FRACTION = r"^([^.,]*\d)[.,](\d{1,9})\d*(.*)$"


def instant(seconds: Column, nanos: Column) -> Column:
    """struct(seconds, nanos) of whole seconds from 1970 in UTC; nanos from 0 to 999,999,999."""
    return F.struct(seconds.cast("long").alias("seconds"), nanos.cast("int").alias("nanos"))


def parse_nanos(text: Column) -> Column:
    """``parse_iso``, or one of the formats without and with an offset, as struct(seconds,
    nanos) that keeps nine digits of the second; null for any other text."""
    fraction = F.regexp_extract(text, _FRACTION, 2)
    plain = F.when(fraction != "", F.concat(F.regexp_extract(text, _FRACTION, 1), F.regexp_extract(text, _FRACTION, 3))).otherwise(text)
    nanos = F.when(fraction != "", F.rpad(fraction, 9, "0").try_cast("int")).otherwise(0)
    return bound(
        F.struct(plain.alias("plain"), nanos.alias("nanos")),
        lambda x: bound(
            F.coalesce(lenient(x["plain"]), *[F.try_to_timestamp(x["plain"], F.lit(f)) for f in _ZONED]),
            lambda t: F.when(t.isNotNull(), instant(F.unix_seconds(t), x["nanos"])),
        ),
    )


def nanos_of_epoch(number: Column) -> Column:
    """A whole number as nano-, micro-, milli- or plain seconds, by its magnitude, with all its
    digits."""

    def made(n: Column) -> Column:
        size = F.abs(n)
        unit = F.when(size > 10**18, 10**9).when(size > 10**15, 10**6).when(size > 10**12, 10**3).otherwise(1).cast("long")
        return bound(unit, lambda u: instant(F.call_function("div", n - F.pmod(n, u), u), F.pmod(n, u) * F.call_function("div", F.lit(10**9).cast("long"), u)))

    return F.when(number.isNotNull(), bound(number.cast("long"), made))


def nanos_text(at: Column) -> Column:
    """ISO text ending in Z with 3, 6 or 9 digits of a second, as many as are needed."""
    digits = F.lpad(at["nanos"].cast("string"), 9, "0")
    short = F.when(digits.endswith("000000"), F.substring(digits, 1, 3)).when(digits.endswith("000"), F.substring(digits, 1, 6)).otherwise(digits)
    return F.concat(F.date_format(F.timestamp_seconds(at["seconds"]), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("."), short, F.lit("Z"))


def nanos_clamped(at: Column, low: str = "1900-01-01", high: str = "2299-12-31 23:59:59") -> Column:
    """An instant held between the first nanosecond of ``low`` and the last of ``high``."""
    first, last = (F.unix_seconds(F.lit(t).cast("timestamp")) for t in (low, high))
    return F.when(at["seconds"] < first, instant(first, F.lit(0))).when(at["seconds"] > last, instant(last, F.lit(999_999_999))).otherwise(at)

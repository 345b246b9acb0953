"""Reading of timestamps in many notations, as Column expressions."""

from __future__ import annotations

from datetime import datetime, timedelta
from zoneinfo import ZoneInfo, ZoneInfoNotFoundError

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .pytext import bind, constant

#: Month names and their usual short forms, by language.
MONTHS = {
    "en": "january february march april may june july august september october november december",
    "en short": "jan feb mar apr may jun jul aug sep oct nov dec",
    "de": "januar februar märz april mai juni juli august september oktober november dezember",
    "de short": "jan feb mär apr mai jun jul aug sep okt nov dez",
    "es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "pt": "janeiro fevereiro março abril maio junho julho agosto setembro outubro novembro dezembro",
}
#: Zero of each decimal digit block that chats use (Arabic, Persian, Devanagari, Bengali, full width).
DIGIT_ZEROS = (0x0660, 0x06F0, 0x0966, 0x09E6, 0xFF10)
#: Marks that are not seen.
INVISIBLE = "\u00ad\u061c\u180e\u200b\u200c\u200d\u200e\u200f\u202a\u202b\u202c\u202d\u202e\u2060\u2061\u2062\u2063\u2064\u2066\u2067\u2068\u2069\ufeff"
_BLANKS = "\t\n\x0b\x0c\r\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"

#: Between the fields of a value that was taken apart.
_MARK = "\x01"
_TIME = r"(\d{1,2})[:h](\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?(?: ?([ap])\.?m\.?(?![a-z]))?(?: uhr)?"
_ZONE = r" ?(z|(?:gmt|utc)?[+-]\d{2}:?\d{2}|(?:gmt|utc)?[+-]\d{1,2}|\[?[a-z]+(?:/[a-z0-9_+-]+)+\]?|\[?[a-z]{2,5}\]?)?"
SLASH = rf"^\[?(\d{{1,2}})/(\d{{1,2}})/(\d{{4}}|\d{{2}}),? {_TIME}\]?{_ZONE}$"
DOTTED = rf"^\[?(\d{{1,2}})\.(\d{{1,2}})\.(\d{{4}}|\d{{2}}),? {_TIME}\]?{_ZONE}$"
ISO = rf"^\[?(\d{{4}})-(\d{{1,2}})-(\d{{1,2}})(?:t|,? ){_TIME}\]?{_ZONE}$"
COMPACT = r"^(\d{4})(\d{2})(\d{2})t?(\d{2})(\d{2})(\d{2})(?:[.,](\d{1,9}))?(z|[+-]\d{2}:?\d{2})?$"
TEXTUAL = rf"^(?:\p{{L}}+\.?,? )?(\d{{1,2}})\.? (\p{{L}}+)\.?,? (\d{{4}}),?(?: at| um)? {_TIME}{_ZONE}$"
EPOCH = r"^(\d{9,10})(?:\.(\d{1,9}))?$|^(\d{13}|\d{16}|\d{19})$"


def plain(c: Column) -> Column:
    """Invisible marks removed, blanks single and outside none, digits of any script as 0 to 9, lower case."""
    zeros = "".join(chr(z + d) for z in DIGIT_ZEROS for d in range(10))
    swapped = F.translate(c, zeros + _BLANKS + INVISIBLE, "0123456789" * len(DIGIT_ZEROS) + " " * len(_BLANKS))
    return F.lower(F.trim(F.regexp_replace(swapped, " +", " ")))


def zone_names(spark: SparkSession) -> list[str]:
    """The region names that the JVM knows; bounded by the zone database."""
    return sorted(z for z in spark._jvm.java.time.ZoneId.getAvailableZoneIds() if "/" in z or z in ("UTC", "GMT"))


def abbreviations(zones: list[str]) -> dict[str, int]:
    """Offset in minutes of each abbreviation, keyed ``zone abbreviation`` in lower case, as used since 2000."""
    out: dict[str, int] = {}
    for zone in zones:
        try:
            info = ZoneInfo(zone)
        except (ZoneInfoNotFoundError, ValueError, OSError):
            continue
        day = datetime(2000, 1, 1, 12)
        while day.year < 2040:
            at = day.replace(tzinfo=info)
            if (name := at.tzname() or "").isalpha():
                out[f"{zone} {name}".lower()] = int(at.utcoffset().total_seconds() // 60)
            day += timedelta(days=30)
    return out


#: Fields of a value that was taken apart, in this order.
_FIELDS = ("kind", "y", "mo", "d", "h", "mi", "s", "frac", "half", "zone")


def _fields(text: Column) -> Column:
    """array<string> of _FIELDS (empty where a field is missing), null if no notation fits; one regex run a field list."""
    rest = {"h": 4, "mi": 5, "s": 6, "frac": 7, "half": 8, "zone": 9}
    notations = (
        ("slash", SLASH, {"d": 1, "mo": 2, "y": 3} | rest),
        ("iso", ISO, {"y": 1, "mo": 2, "d": 3} | rest),
        ("epoch", EPOCH, {"s": 1, "frac": 2, "y": 3}),
        ("dotted", DOTTED, {"d": 1, "mo": 2, "y": 3} | rest),
        ("textual", TEXTUAL, {"d": 1, "mo": 2, "y": 3} | rest),
        ("compact", COMPACT, {"y": 1, "mo": 2, "d": 3, "h": 4, "mi": 5, "s": 6, "frac": 7, "zone": 8}),
    )
    found = F.lit(None).cast("string")
    for kind, pattern, at in reversed(notations):
        apart = _MARK.join([kind, *(f"${at[k]}" if k in at else "" for k in _FIELDS[1:])])
        found = F.when(text.rlike(pattern), F.regexp_replace(text, pattern, apart)).otherwise(found)
    return F.split(found, _MARK)


def _local_us(f: dict[str, Column], day: str, month: str) -> Column:
    """Wall clock as microseconds, null where there is no such date or time of day."""
    months = {name: i % 12 + 1 for names in MONTHS.values() for i, name in enumerate(names.split())}
    named = F.try_element_at(constant(months, "map<string,int>"), f[month])
    hour = f["h"].try_cast("int")
    hour = F.when(f["half"] == "", hour).when(hour.between(1, 12), hour % 12 + F.when(f["half"] == "p", 12).otherwise(0))
    sec = F.concat(F.lit("0"), f["s"], F.lit("."), F.substring(F.rpad(f["frac"], 6, "0"), 1, 6)).try_cast("decimal(9,6)")
    year = f["y"].try_cast("int") + F.when(F.length(f["y"]) == 2, 2000).otherwise(0)
    minute = f["mi"].try_cast("int")
    ts = F.try_make_timestamp_ntz(year, F.coalesce(f[month].try_cast("int"), named), f[day].try_cast("int"), F.when(hour.between(0, 23) & (minute < 60) & (sec < 60), hour), minute, sec.cast("decimal(8,6)"))
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def _epoch_us(f: dict[str, Column]) -> Column:
    seconds = f["s"].try_cast("bigint") * 1_000_000 + F.substring(F.rpad(f["frac"], 6, "0"), 1, 6).try_cast("bigint")
    return F.when(f["y"] == "", seconds).when(F.length(f["y"]) == 13, f["y"].try_cast("bigint") * 1000).otherwise(F.substring(f["y"], 1, 16).try_cast("bigint"))


def readings(text: Column) -> Column:
    """Every calendar reading of a value: array<struct<kind, local_us, zone>>, null if no notation fits.

    A slash date has two readings, dmy before mdy. local_us is null for an impossible date or time; epoch values have zone z.
    """

    def of(a: Column) -> Column:
        f = {k: a[i] for i, k in enumerate(_FIELDS)}

        def one(kind: Column, us: Column, zone: Column) -> Column:
            return F.struct(kind.alias("kind"), us.alias("local_us"), zone.alias("zone"))

        zone = F.nullif(f["zone"], F.lit(""))
        return (
            F.when(f["kind"] == "slash", F.array(one(F.lit("dmy"), _local_us(f, "d", "mo"), zone), one(F.lit("mdy"), _local_us(f, "mo", "d"), zone)))
            .when(f["kind"] == "epoch", F.array(one(f["kind"], _epoch_us(f), F.lit("z"))))
            .when(f["kind"].isNotNull(), F.array(one(f["kind"], _local_us(f, "d", "mo"), zone)))
        )

    return bind(plain(text), lambda t: bind(_fields(t), of))


def utc_us(local: Column, zone: Column, device_zone: Column, names: list[str], offsets: dict[str, int]) -> Column:
    """The instant of a wall clock; null where its zone is unknown or skips it. A repeated time is the earlier one.

    zone is what the text says (lower case, null if nothing): an offset, a region or an abbreviation of device_zone.
    An abbreviation that device_zone doesn't use counts as nothing said.
    """
    known = constant({z.lower(): z for z in names}, "map<string,string>")
    pairs = constant(offsets, "map<string,int>")

    def of(said: Column) -> Column:
        numeric = F.regexp_replace(said, "^(?:gmt|utc)(?=[+-])", "")
        digits = F.regexp_replace(F.substring(numeric, 2, 6), ":", "")
        minutes = F.when(F.length(digits) <= 2, digits.try_cast("int") * 60).otherwise(F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int"))
        offset = (
            F.when(said.isNull() | said.contains("/"), F.lit(None).cast("int"))
            .when(said.isin("z", "utc", "gmt"), F.lit(0))
            .when(numeric.rlike(r"^[+-]\d"), minutes * F.when(numeric.startswith("-"), -1).otherwise(1))
            .otherwise(F.try_element_at(pairs, F.concat_ws(" ", F.lower(device_zone), said)))
        )
        return F.struct(offset.alias("minutes"), F.when(offset.isNull(), F.try_element_at(known, F.lower(F.when(said.contains("/"), said).otherwise(device_zone)))).alias("place"))

    def instant(at: Column) -> Column:
        wall = F.timestamp_micros(local)
        there = bind(F.to_utc_timestamp(wall, at["place"]), lambda u: F.when(F.from_utc_timestamp(u, at["place"]) == wall, F.unix_micros(u)))
        return F.when(at["minutes"].isNotNull(), local - at["minutes"].cast("bigint") * 60_000_000).otherwise(there)

    return bind(of(F.regexp_replace(zone, r"^\[|\]$", "")), instant)

"""Free-form date text to ISO text, dates and times of day, without leaving the JVM.

Accepted date texts (after lower-casing), month first unless ``day_first``, which leaves those alone that
begin with the year:

- year, month and day as numbers with one of ``- / .`` or blank between them, or as 6 or 8 digits;
- two of them with ``-`` or ``/``; a lone number of up to four digits;
- an English month name with a day and/or a year on either side, an optional weekday before it;
- a time ``h:mm[:ss[.f]]``, ``h am``, ``10h15``, with an optional UTC offset, after the date or before it,
  or alone; missing date parts come from ``as_of``.

Everything else is unparseable. A year beyond the 32-bit range is not a bad date but an overflow.
"""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newszones import fixed_values as fixed
from newszones.functions.text import WHITESPACE


def iso_text(ts: Column) -> Column:
    """A timestamp as ISO text, with a fraction only if there is one."""
    fraction = F.date_format(ts, "SSSSSS")
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
                    F.when(fraction == "000000", "").otherwise(F.concat(F.lit("."), fraction)))


def _alternatives(names) -> str:
    return "|".join(sorted(names, key=len, reverse=True))


# Numbers: one that can only be a year, a day that cannot be a month, a month, anything of two digits.
_YEAR = r"\d{3,}|3[2-9]|[4-9]\d"
_PAST_MONTHS = r"1[3-9]|2\d|3[01]"
_MONTH = r"0?\d|1[0-2]"
_TWO = r"\d{1,2}"
_NAME = _alternatives(name for names in fixed.MONTHS.values() for name in names)
_WEEKDAY = rf"(?:(?:{_alternatives(fixed.WEEKDAYS)})[., ]+)?"
_NAMED_GAP = r"\.?[ ,./-]+(?:of +)?"
_ORDINAL = "(?:st|nd|rd|th)?"

_ZONE = r"(?: *(?<z{k}>(?<![apm.])z|[+-]\d\d:?\d\d|[+-]\d{{1,2}}))?"
_TIME = (
    r"(?:(?<h1>\d{1,2}):(?<i1>\d{1,2})(?::(?<s1>\d{1,2})(?:[.,](?<f1>\d+))?\.?)?(?: *(?<a1>[ap])\.?m?\.?)?"
    + _ZONE.format(k=1)
    + r"|(?<h2>\d{1,2}) *(?<a2>[ap])\.?m?\.?|(?<h3>\d{1,2})h(?: ?(?<i3>\d{1,2})m?)?)"
)


def _run(k: int) -> str:
    """Hours, minutes and seconds without colons, behind a full date in numbers."""
    return (rf"(?:(?:t| +)(?<h{k}>\d\d)(?:(?<i{k}>\d\d)(?<s{k}>\d\d)?)?(?![\d:h])"
            + _ZONE.format(k=k) + ")?")


_AFTER_DATE = (
    r"(?:[,;.']* +(?:[-/] +)?(?:(?:at|on|t) +)?|[,;]|(?<=\d)t"
    r"|(?<=\d[-/.](?:\d{1,2}|[a-z]{3,9})[-/.]\d{1,4})-(?=\d{1,2}[:h]))"
)
_TIME_FIRST = (
    r"^(\d{1,2}(?::[\d:.]*|h\d*m?|(?= *[ap](?:\.?m)?\b))(?: *[ap](?:\.?m)?\b\.?)?+(?: *(?:z|[+-][\d:]+))?+)"
    r"[ ,;']+(?:on +)?(?=[a-z]{3}|\d)(.+)$"
)


def _pattern(day_first: bool) -> str:
    """One pattern for all dates. A group's first letter tells the part: year, month, day, name, h, i, s, f, a, z."""

    def numbers(k, sep, again, two, year, first_year, month):
        """Three numbers: year first, day first because it is no month or because that is asked for, month first."""

        def order(j, first, second, third):
            name = f"sep{k}{j}"
            return first + sep.format(name) + second + again.format(name) + third

        y, m, d = (lambda j, x, letter=letter: f"(?<{letter}{k}{j}>{x})" for letter in "ymd")
        ways = [order(1, y(1, first_year), m(1, two), d(1, two)), order(2, d(2, _PAST_MONTHS), m(2, two), y(2, year))]
        if day_first:
            ways.append(order(3, d(3, two), m(3, month), y(3, year)))
        ways.append(order(4, m(4, month), d(4, two), y(4, year)))
        return "|".join(ways)

    separated = numbers(1, r"(?<{}>[-/. ])", r"\k<{}>", _TWO, r"\d+", _YEAR, _MONTH)
    glued = numbers(2, "", "", r"\d\d", r"\d\d", "3[2-9]|[4-9][0-9]", "0[0-9]|1[0-2]")
    pair = rf"(?<y31>{_YEAR})[-/](?<m31>{_TWO})|(?<m32>{_TWO})[-/](?<y32>{_YEAR})"
    if day_first:
        pair += rf"|(?<d34>{_TWO})[-/](?<m34>{_MONTH})(?!\d)"
    pair += rf"|(?<m33>{_TWO})[-/](?<d33>{_TWO})"
    named = (
        rf"(?<y41>{_YEAR}){_NAMED_GAP}(?<n41>{_NAME})(?:{_NAMED_GAP}(?<d41>{_TWO}){_ORDINAL})?"
        rf"|(?<d42>{_TWO}){_ORDINAL}{_NAMED_GAP}(?<n42>{_NAME})(?:{_NAMED_GAP}(?<y42>\d+)(?!:))?"
        rf"|(?<n43>{_NAME}){_NAMED_GAP}(?<d43>[012]?\d|3[01]){_ORDINAL}(?![:\d])(?:{_NAMED_GAP}(?<y43>\d+)(?!:))?"
        rf"|(?<n44>{_NAME}){_NAMED_GAP}(?<y44>{_YEAR})(?!:)(?:{_NAMED_GAP}(?<d44>{_TWO})(?!:))?"
        rf"|(?<n45>{_NAME})\.?"
    )
    eight = r"(?<y51>\d{4})(?<m51>\d\d)(?<d51>\d\d)(?:(?<h5>\d\d)(?<i5>\d\d)(?<s5>\d\d)?(?=$))?"
    lone = rf"(?!(?:\d{{6}}|\d{{8}}|\d{{12}}|\d{{14}})(?!\d))(?<y61>{_YEAR})(?![\d:h])|(?<d61>{_TWO}){_ORDINAL}(?![\d:h])"
    date = (rf"{_WEEKDAY}(?:(?:{separated}){_run(4)}|{eight}(?!\d){_run(6)}"
            rf"|(?:{glued})(?!\d)|{pair}|{named}|{lone})")
    return rf"^(?=.)(?:{date}(?:{_AFTER_DATE}(?={_TIME_AHEAD})|(?=[ ,;.]*$)))?(?:{_TIME})?[ ,;.]*$"


_TIME_AHEAD = r"\d{1,2}(?::| *[aph])"
_MARK, _MATCHED = "\u0001", "\u0002"
_PARTS = "ymdnhisfaz"
_PARTS_DDL = ("mark string, y string, m int, d int, n string, h int, i int, s string, f string, a string, z string")


def _template(pattern: str) -> str:
    groups = re.findall(r"\(\?<([a-z]\w*)>", pattern)
    parts = ["".join(f"${{{g}}}" for g in groups if re.fullmatch(rf"{p}\d+", g)) for p in _PARTS]
    return _MARK.join([_MATCHED, *parts])


def _english_months(text: Column) -> Column:
    """Replace Spanish month names, and the ``de`` between the parts, by what the pattern knows."""
    for number, names in fixed.SPANISH_MONTHS.items():
        text = F.regexp_replace(text, rf"\b(?:{_alternatives(names)})\b", fixed.MONTHS[number][-1])
    return F.regexp_replace(text, r" +del? +", " ")


def parse_dates(
    df: DataFrame,
    text: str,
    into: str = "parsed",
    *,
    as_of: Column,
    day_first: bool = False,
    month_names: str = "en",
) -> DataFrame:
    """Add the struct column ``into``: ``iso`` text, ``day``, ``clock`` and ``overflow``.

    One match sorts the text into year, month, day, time and offset; what follows is arithmetic. Each step
    is a projection of its own, so that its values are computed once. ``as_of`` is a timestamp without
    time zone.
    """
    if month_names not in ("en", "es"):
        raise ValueError(f"unknown month names: {month_names}")
    kept = df.columns
    source = F.translate(F.col(text), WHITESPACE, " " * len(WHITESPACE))
    if month_names == "es":
        source = _english_months(source)
    pattern = _pattern(day_first)
    p, n, t, now = (f"__{into}_{x}" for x in ("parts", "numbers", "local", "now"))
    sorted_out = F.regexp_replace(F.regexp_replace(source, _TIME_FIRST, "$2 $1"), pattern, _template(pattern))
    df = df.withColumn(p, F.from_csv(sorted_out, _PARTS_DDL, {"sep": _MARK})).withColumn(now, as_of)
    months = "".join(fixed.MONTHS[k][0][:3] for k in range(1, 13))
    zone = f"regexp_replace({p}.z, '[^0-9]', '')"
    # A year of two digits is the one closest to the present.
    df = df.withColumn(n, F.expr(f"""
        if({p}.mark = '{_MATCHED}', named_struct(
            'y', case when {p}.y is null then year({now})
                      when length({p}.y) > 2 then try_cast({p}.y as int)
                      else year({now}) - 50 + pmod(cast({p}.y as int) - year({now}) + 50, 100) end,
            'm', coalesce({p}.m, cast((locate(left({p}.n, 3), '{months}') + 2) / 3 as int), month({now})),
            'h', case when {p}.a is null then coalesce({p}.h, 0) when {p}.h > 12 then -1
                      when {p}.a = 'p' then {p}.h % 12 + 12 else {p}.h % 12 end,
            's', cast(concat(coalesce({p}.s, '0'), '.', left(coalesce({p}.f, '0'), 6)) as decimal(16, 6)),
            'shift', coalesce(try_cast(left({zone}, 2) as int), 0) * 60 + coalesce(try_cast(substr({zone}, 3) as int), 0)
        ), null)"""))
    # A missing day is that of as_of, or the month's last if that is earlier.
    df = df.withColumn(t, F.expr(f"""
        case when {n}.y between 1 and 9999 and {n}.m between 1 and 12 and {n}.s < 60 and {n}.shift < 1440
             then cast(try_make_timestamp_ntz({n}.y, {n}.m, coalesce({p}.d, day(add_months(
                      cast({now} as date), ({n}.y - year({now})) * 12 + {n}.m - month({now})))),
                  {n}.h, coalesce({p}.i, 0), {n}.s) as string) end"""))
    result = F.expr(f"""
        named_struct(
            'iso', concat(left({t}, 10), 'T', substr({t}, 12, 8),
                if(length({t}) > 19, concat('.', rpad(substr({t}, 21), 6, '0')), ''),
                case when {p}.z is null then '' when {n}.shift = 0 then '+00:00'
                     else concat(left({p}.z, 1), lpad({n}.shift div 60, 2, '0'), ':', lpad({n}.shift % 60, 2, '0')) end),
            'day', cast(left({t}, 10) as date),
            'clock', concat(substr({t}, 12, 8), '.', rpad(substr({t}, 21), 6, '0')),
            'overflow', coalesce({p}.mark = '{_MATCHED}' and {n}.h >= 0 and length({p}.y) > 9
                                 and coalesce(try_cast({p}.y as bigint), 9999999999) > 2147483647, false))""")
    # Exploding a single struct changes nothing, but keeps the optimizer from pushing a filter on the result
    # below all these projections, which would repeat them inside the filter, each nested in the next.
    return df.select(*kept, F.explode(F.array(result)).alias(into))


def parse_fecha(df: DataFrame, col: str = "fecha", *, as_of: Column, **options) -> DataFrame:
    """Replace a date text by its ISO form; unparseable text stays. Adds ``fecha_overflow``."""
    return (
        parse_dates(df, col, "__date", as_of=as_of, **options)
        .withColumn(col, F.coalesce("__date.iso", col))
        .withColumn("fecha_overflow", F.col("__date.overflow"))
        .drop("__date")
    )


def split_date_time(df: DataFrame, col: str = "fecha", *, as_of: Column, **options) -> DataFrame:
    """Add ``fecha_noticia`` and ``hora_noticia`` from a date text; the UTC offset is dropped, not applied."""
    return (
        parse_dates(df, col, "__date", as_of=as_of, **options)
        .withColumn("fecha_noticia", F.col("__date.day"))
        .withColumn("hora_noticia", F.col("__date.clock"))
        .drop("__date")
    )


_ISO = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(?:\.\d{6})?(?:[+-]\d\d:\d\d)?$"


def iso_day(col: Column) -> Column:
    """Day of an ISO text as ``parse_fecha`` writes it; NULL for any other text."""
    return F.when(col.rlike(_ISO), F.substring(col, 1, 10).try_cast("date"))


def iso_clock(col: Column) -> Column:
    """Time of day of an ISO text as ``parse_fecha`` writes it, ``HH:mm:ss.SSSSSS``."""
    return F.when(col.rlike(_ISO), F.concat(
        F.substring(col, 12, 8), F.lit("."),
        F.rpad(F.regexp_extract(col, r"\.(\d{6})", 1), 6, "0")))


# Date, one separating character, hours with optional minutes, seconds and fraction, UTC offset.
_STRICT = (
    r"^(\d{4})-?(\d\d)-?(\d\d)(?:[^\x{d800}-\x{dfff}](\d\d)(?::?(\d\d)(?::?(\d\d)(?:[.,](\d+))?)?)?"
    r"(?:([+-]\d\d)(?::?(\d\d)(?::?(\d\d)(?:[.,](\d+))?)?)?)?)?$"
)
# Dashes and colons are used throughout a part or not at all.
_STRICT_SHAPE = (
    r"^(?:\d{4}-\d\d-\d\d|\d{8})(?:.(?:\d\d(?::\d\d(?::\d\d(?:[.,]\d+)?)?)?|\d{4}(?:\d\d(?:[.,]\d+)?)?)"
    r"(?:[+-](?:\d\d(?::\d\d(?::\d\d(?:[.,]\d+)?)?)?|\d{4}(?:\d\d(?:[.,]\d+)?)?))?)?$"
)


def date_saved_iso(col: Column) -> Column:
    """Canonical form of a strict ISO 8601 text, NULL for anything else."""

    def part(group):
        return F.regexp_extract(col, _STRICT, group)

    def two(group):
        return F.lpad(part(group), 2, "0")

    def fraction(group):
        micros = F.rpad(F.substring(part(group), 1, 6), 6, "0")
        return F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros))

    day = F.concat_ws("-", part(1), part(2), part(3))
    zone_seconds = F.concat(F.lit(":"), two(10), fraction(11))
    zone = F.when(part(8) == "", "").otherwise(F.concat(
        part(8), F.lit(":"), two(9), F.when(zone_seconds == ":00", "").otherwise(zone_seconds)))
    valid = (
        col.rlike(_STRICT_SHAPE)
        & (part(1) != "0000")
        & day.try_cast("date").isNotNull()
        & (two(4) < "24") & (two(5) < "60") & (two(6) < "60")
        & ((part(8) == "") | ((F.substring(part(8), 2, 2) < "24") & (two(9) < "60") & (two(10) < "60")))
    )
    return F.when(valid, F.concat(
        day, F.lit("T"), two(4), F.lit(":"), two(5), F.lit(":"), two(6), fraction(7),
        F.when(zone == "-00:00", "+00:00").otherwise(zone)))


_CLOCK = r"^([01]?\d|2[0-3]):([0-5]?\d):([0-5]?\d)(?:\.(\d{1,9}))?$"


def coerce_time(col: Column) -> Column:
    """``H:M:S`` with or without a fraction as ``HH:mm:ss.SSSSSS``, NULL for anything else."""
    hms = F.concat_ws(":", *[F.lpad(F.regexp_extract(col, _CLOCK, k), 2, "0") for k in (1, 2, 3)])
    micros = F.rpad(F.substring(F.regexp_extract(col, _CLOCK, 4), 1, 6), 6, "0")
    return F.when(col.rlike(_CLOCK), F.concat(hms, F.lit("."), micros))


def coerce_date(col: Column) -> Column:
    """A date from a date or text value, NULL if it is none."""
    return col.try_cast("date")

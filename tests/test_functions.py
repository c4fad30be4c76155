"""Edge rows with hand-derived results, and properties against the Python standard library."""

import random
import re
import urllib.parse
from datetime import date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newszones.functions import dates, records, text, urls


def as_of():
    return F.expr("timestamp_ntz'2026-12-01 00:00:00'")


def column(spark, values, expression, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_normalize_and_null_tokens(spark):
    got = column(spark, ["  Él DIJO  ", "  ", " Null ", "", " x\u001c", None],
                 lambda c: text.null_tokens(text.normalize_text(c)))
    assert got == ["él dijo", None, None, None, "x", None]


@pytest.mark.parametrize("order, expected", [
    ("clean_then_links", ["sube la economa 5", "a b c", "ver httpwwwxcomy ahora", "", None]),
    ("links_then_clean", ["sube la economa 5", "a b c", "ver ahora", "", None]),
])
def test_clean_description(spark, order, expected):
    raw = ["¡Sube la ECONOMÍA 5%! \U0001f600", "a b\u001cc", "ver http://www.x.com/y ahora", "¡¡¡!!!", None]
    assert column(spark, raw, lambda c: text.clean_description(text.normalize_text(c), order)) == expected


def test_unknown_order_is_refused():
    with pytest.raises(ValueError):
        text.clean_description(None, "other")


def test_list_is_joined_and_keeps_case(spark):
    got = column(spark, [["Uno DOS", "Tres"]], lambda c: text.clean_description(text.join_list(c)), "array<string>")
    assert got == ["Uno DOS Tres"]


def test_first_of_list(spark):
    assert column(spark, [["a", "b"], [], None], records.first_of_list, "array<string>") == ["a", None, None]


def test_run_stamp(spark):
    assert spark.range(1).select(records.run_stamp(F.lit(datetime(2025, 4, 1, 3, 0, 9)))).first()[0] == "20250401_030009"


LINK = "https?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\\(\\),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+"


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.one_of(
    st.sampled_from(list(text.WHITESPACE + "aZ9é/.:%$_~#'\"{}|www.http://")), st.characters(codec="utf-8",
    exclude_characters="\x00"))), min_size=40, max_size=80))
def test_text_matches_python(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "x string").select(
        "x", text.strip(F.col("x")).alias("s"), text.clean_text(F.col("x")).alias("c"),
        text.remove_links(F.col("x")).alias("l"),
        text.clean_text(text.clean_text(F.col("x"))).alias("cc")).collect()
    for r in rows:
        assert r.s == r.x.strip()
        assert r.c == re.sub(r"\s+", " ", re.sub(r"[^a-zA-Z0-9\s]", "", r.x)).strip()
        assert r.l == re.sub(r"www\.[^\s]+", "", re.sub(LINK, "", r.x)).strip()
        assert r.cc == r.c and re.fullmatch("[a-zA-Z0-9 ]*", r.c)


def test_whitespace_is_pythons_whole_set(spark):
    every = [(i, chr(i)) for i in [*range(1, 0x3100), *range(0xFE00, 0x10000)]]
    df = spark.createDataFrame(every, "i int, x string").select(
        "i", (text.strip(F.col("x")) == "").alias("stripped"),
        (text.clean_text(F.concat(F.lit("a"), "x", F.lit("b"))) == "a b").alias("collapsed"))
    wrong = [r.i for r in df.collect() if not (r.stripped == r.collapsed == chr(r.i).isspace())]
    assert not wrong


def test_no_link_survives_cleaning(spark):
    raw = ["http://a.b/c www.x.y z", "https://www.é.com/ñ", "www.a"]
    cleaned = column(spark, raw, text.clean_text)
    assert column(spark, raw, lambda c: text.remove_links(text.clean_text(c))) == cleaned
    assert column(spark, raw, text.clean_description) == cleaned


AUTHORITIES = [
    ("https://eldeber.com.bo/pais/x", "eldeber.com.bo", "eldeber"),
    ("https://www.lostiempos.com/a", "www.lostiempos.com", "lostiempos"),
    ("https://ahoraelpueblo.bo/index.php/a", "ahoraelpueblo.bo", "ahoraelpueblo"),
    ("https://user@www.eldeber.com.bo:443/x", "user@www.eldeber.com.bo:443", "eldeber"),
    ("https://noteldeber.com.bo.example/x", "noteldeber.com.bo.example", "eldeber"),
    ("http://www.example.com.bo/a", "www.example.com.bo", "www"),
    ("https://blog.x.example.net", "blog.x.example.net", "example"),
    ("//a.b.com/x", "a.b.com", "b"),
    ("http://localhost/", "localhost", "localhost"),
    ("example/path", "", ""),
    ("http://[bad/x", None, None),
    ("http://a？b.c/x", None, None),
    ("http://[::1]:8/x", "[::1]:8", "[::1]:8"),
]


def test_authority_and_source(spark):
    values = [u for u, _, _ in AUTHORITIES]
    assert column(spark, values, urls.url_authority) == [a for _, a, _ in AUTHORITIES]
    assert column(spark, [*values, None, ""], urls.source_from_url) == [*[s for _, _, s in AUTHORITIES], None, None]


def test_allowed_domains(spark):
    values = ["https://eldeber.com.bo/x", "https://WWW.eldeber.com.bo:443/x", "https://noteldeber.com.bo/",
              "https://eldeber.com.bo.example/x", "/x", None]
    assert column(spark, values, urls.on_allowed_domain) == [True, True, False, False, False, False]


BASES = ["https://eldeber.com.bo/pais/1/", "https://eldeber.com.bo/pais/1", "http://a.b", "http://a.b/x?q=1#f",
         "HTTP://A.b/x/y/z/"]
HREFS = ["/x/y", "a/b", "//h.bo/p", "?q=1", "../z", "https://o.bo/", "#f", "", "..", "../../../z", "/a/../b", "./",
         "a/./b/..", "mailto:x@y", "javascript:void(0)", "http://c.d/../e", " /sp ", "/a//b", "a//b/", "a?x=1#",
         "x#?", "/..", "https://eldeber.com.bo", "HTTPS://eldeber.com.bo/Q", "\t/tab\n/x"]


def test_resolve_url_matches_urljoin(spark):
    pairs = [(b, h) for b in BASES for h in HREFS]
    rng = random.Random(5)
    for _ in range(400):
        pairs.append((rng.choice(BASES), "".join(rng.choice(["a", "b", "/", "..", ".", "?", "#", "x"])
                                                 for _ in range(rng.randint(0, 7)))))
    rows = spark.createDataFrame(pairs, "b string, h string").select(
        "b", "h", urls.resolve_url(F.col("b"), F.col("h")).alias("r")).collect()
    for r in rows:
        try:
            expected = urllib.parse.urljoin(r.b, r.h)
        except ValueError:
            continue
        assert r.r == expected, (r.b, r.h)


FECHAS = [
    ("2025-04-01t08:30:00-04:00", "2025-04-01T08:30:00-04:00", date(2025, 4, 1), "08:30:00.000000"),
    ("2025-04-01t08:30:00.5z", "2025-04-01T08:30:00.500000+00:00", date(2025, 4, 1), "08:30:00.500000"),
    ("2025-04-01", "2025-04-01T00:00:00", date(2025, 4, 1), "00:00:00.000000"),
    ("01/04/2025", "2025-01-04T00:00:00", date(2025, 1, 4), "00:00:00.000000"),
    ("13/04/2025", "2025-04-13T00:00:00", date(2025, 4, 13), "00:00:00.000000"),
    ("07.04.2025 10:15", "2025-07-04T10:15:00", date(2025, 7, 4), "10:15:00.000000"),
    ("1 apr 2025", "2025-04-01T00:00:00", date(2025, 4, 1), "00:00:00.000000"),
    ("10:15", "2026-12-01T10:15:00", date(2026, 12, 1), "10:15:00.000000"),
    ("12 de abril de 2025", "12 de abril de 2025", None, None),
    ("5", "2026-12-05T00:00:00", date(2026, 12, 5), "00:00:00.000000"),
    ("2025", "2025-12-01T00:00:00", date(2025, 12, 1), "00:00:00.000000"),
    ("30/02/2025", "30/02/2025", None, None),
    ("hace 5 horas", "hace 5 horas", None, None),
    ("99999999999999999999", "99999999999999999999", None, None),
    (None, None, None, None),
]


def test_fecha(spark):
    df = spark.createDataFrame([(i, f[0]) for i, f in enumerate(FECHAS)], "i int, fecha string")
    parsed = dates.parse_fecha(df, as_of=as_of()).orderBy("i").collect()
    assert [r.fecha for r in parsed] == [f[1] for f in FECHAS]
    assert [r.fecha for r in parsed if r.fecha_overflow] == ["99999999999999999999"]
    split = dates.split_date_time(df, as_of=as_of()).orderBy("i").collect()
    assert [(r.fecha_noticia, r.hora_noticia) for r in split] == [f[2:] for f in FECHAS]
    # ISO text, once written, is read the short way with the same result.
    again = column(spark, [f[1] for f in FECHAS], lambda c: F.struct(dates.iso_day(c), dates.iso_clock(c)))
    assert [tuple(r) for r in again] == [f[2:] for f in FECHAS]


def test_fecha_options(spark):
    df = spark.createDataFrame([("01/04/2025",), ("12 de abril de 2025",), ("3 de ene de 2024 10:15",)], "fecha string")
    out = dates.parse_fecha(df, as_of=as_of(), day_first=True, month_names="es").collect()
    assert [r.fecha for r in out] == ["2025-04-01T00:00:00", "2025-04-12T00:00:00", "2024-01-03T10:15:00"]
    with pytest.raises(ValueError):
        dates.parse_fecha(df, as_of=as_of(), month_names="fr")


@pytest.mark.parametrize("day_first", [False, True])
def test_fecha_matches_dateutil(spark, day_first):
    """Over the documented grammar the result is that of the well-known parser, overflow included."""
    parser = pytest.importorskip("dateutil.parser")
    rng = random.Random(11)

    def two(n):
        return rng.choice([str(n), f"{n:02d}"])

    def day_text():
        y, m, d = rng.randint(1950, 2049), rng.randint(1, 13), rng.randint(1, 31)
        name = rng.choice(["jan", "february", "mar", "april", "may", "jun", "july", "sept", "october", "dec"])
        sep = rng.choice("-/.")
        short = f"{y % 100:02d}"
        return rng.choice([
            f"{y}{sep}{two(m)}{sep}{two(d)}", f"{two(m)}{sep}{two(d)}{sep}{y}", f"{two(d)}{sep}{two(m)}{sep}{y}",
            f"{two(d)}{sep}{two(m)}{sep}{short}", f"{d} {name} {y}", f"{name} {d}, {y}", f"{d}-{name}-{y}",
            f"{name} {y}", f"{d} {name}", f"sat, {d} {name} {y}", f"{y}{m:02d}{d:02d}", f"{two(m)}/{y}",
            f"{y}-{two(m)}", f"{two(m)}/{two(d)}", str(rng.randint(32, 99999)), str(rng.randint(1, 31)),
            f"1/2/{rng.choice([2147483647, 2147483648, 10**19])}"])

    def time_text():
        t = f"{two(rng.randint(0, 24))}:{rng.randint(0, 60):02d}"
        if rng.random() < 0.6:
            t += f":{rng.randint(0, 60):02d}" + rng.choice(["", "." + str(rng.randint(0, 9999999))])
        return t + rng.choice(["", "", "", " am", " p.m."]) + rng.choice(["", "", " +05:30", " -0400", " -04"])

    values = [day_text() for _ in range(1500)] + [time_text() for _ in range(200)]
    values += [f"{day_text()}{rng.choice([' ', ', ', ' - '])}{time_text()}" for _ in range(2000)]
    if day_first:
        values = [v for v in values if not re.match(r"\d{3,}|.*\d{4}-\d\d?-|3[2-9]|[4-9]\d", v)]
    default = datetime(2026, 12, 1)

    def expected(value):
        try:
            return parser.parse(value, default=default, dayfirst=day_first).isoformat()
        except OverflowError:
            return "overflow"
        except ValueError:
            return None

    df = spark.createDataFrame([(v,) for v in values], "x string")
    rows = dates.parse_dates(df, "x", as_of=as_of(), day_first=day_first).select("x", "parsed.*").collect()
    wrong = [(r.x, r.iso, expected(r.x)) for r in rows
             if ("overflow" if r.overflow else r.iso) != expected(r.x)]
    assert not wrong, (len(wrong), wrong[:20])


SAVED = ["2025-04-01T12:00:00.123456", "2025-04-01t12:00:00", "2025-04-01 12:00", "2025-04-01", "20250401T1200",
         "2025-04-01T12:00:00-04:00", "2025-04-01T12:00:00+0530", "2025-04-01T12:00:00,5", "2025-04-01T12:00:00.1234567",
         "2025-04-01T24:00:00", "2025-02-30", "2025-4-1", "ayer", "", None, "2025-04-01T12:00:00+25:00",
         "2025-04-01T12:00:00-00:00", "2025-04-01T12:00:00+05:30:10", "0000-01-01", "2025-04-01T12:60", "2025-04-01T"]


def test_date_saved(spark):
    def expected(value):
        try:
            return datetime.fromisoformat(value).isoformat()
        except (ValueError, TypeError):
            return None

    got = column(spark, SAVED, dates.date_saved_iso)
    assert dict(zip(SAVED, got)) == {v: expected(v) for v in SAVED}


def test_coercion(spark):
    assert column(spark, ["08:30:00", "8:3:0.5", "08:30:00.1234567", "25:00:00", "08:30", "x", None],
                  dates.coerce_time) == ["08:30:00.000000", "08:03:00.500000", "08:30:00.123456", None, None, None, None]
    assert column(spark, ["2025-04-01", "2025-02-30", "x", None], dates.coerce_date) == [date(2025, 4, 1), None, None, None]

"""The catalogue's queries as SQL on the same tables, written from the rules and not from the Spark code."""

_SPACES = [
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
    0x205F, 0x3000,
]
_WS = "".join(f"\\x{{{c:x}}}" for c in _SPACES)
_WS_TEXT = "".join(map(chr, _SPACES))
_LINK = "a-zA-Z0-9$-_@.&+!*(),"
_AS_OF = "2026-12-01"


def _strip(x):
    return f"trim({x}, '{_WS_TEXT}')"


def _normal(x):
    return _strip(f"lower({x})")


def _no_token(x):
    return f"CASE WHEN {x} NOT IN ('', ' ', 'null') THEN {x} END"


def _clean(x):
    return (f"{_strip('regexp_replace(regexp_replace(' + x + f''', '[^a-zA-Z0-9{_WS}]', '', 'g'), '[{_WS}]+', ' ', 'g')''')}")


def _unlink(x):
    return _strip(
        f"regexp_replace(regexp_replace({x}, 'https?://[{_LINK}]+', '', 'g'), 'www\\.[^{_WS}]+', '', 'g')")


_ODD_END = "chr(28) || 'y ' || chr(128512)"

_URLS = """SELECT page_id, CASE WHEN page_id % 10 = 0 THEN regexp_replace(u, '^https?://', '') ELSE u END AS url
FROM (SELECT page_id, replace(replace(url, 'spam-farm.example.org', 'eldeber.com.bo'), 'example.com', 'com.bo') AS u
      FROM pages)"""

_HOSTS = """SELECT page_id, 'https://' || ['eldeber.com.bo', 'www.lostiempos.com', 'notahoraelpueblo.bo',
  'EL.AhoraElPueblo.bo', 'lostiempos.com:8080', 'user@eldeber.com.bo', 'eldeber.com.bo.example',
  'example.org'][page_id % 8 + 1] || '/n/' || page_id AS url
FROM pages"""

_AUTHORITY = "regexp_extract(url, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)', 1)"

_FUENTE = """CASE WHEN url IS NULL OR url = '' THEN NULL
     WHEN contains(a, 'eldeber.com.bo') THEN 'eldeber'
     WHEN contains(a, 'lostiempos.com') THEN 'lostiempos'
     WHEN contains(a, 'ahoraelpueblo.bo') THEN 'ahoraelpueblo'
     WHEN len(string_split(a, '.')) < 2 THEN a
     WHEN string_split(a, '.')[-2] = 'com' THEN string_split(a, '.')[1]
     ELSE string_split(a, '.')[-2] END"""

_CAPTURED = """SELECT page_id,
  CASE page_id % 5 WHEN 0 THEN 'eldeber' WHEN 1 THEN 'lostiempos' WHEN 2 THEN 'ahoraelpueblo' WHEN 3 THEN 'otro' END
    AS source,
  CASE WHEN page_id % 3 = 0 THEN 'pais' ELSE 'mundo' END AS section,
  CAST(page_id % 10 + 1 AS INTEGER) AS page, url, html,
  CASE WHEN page_id % 17 = 0 THEN 404 ELSE 200 END AS status
FROM pages"""

_DAY = "lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0')"

# Articles as they come out of normalisation, with the reason for rejecting them.
_NORMAL = f"""SELECT doc_id, 'd-' || doc_id AS data_id, lower(source) AS source,
  CASE WHEN doc_id % 11 > 1 THEN 'nota ' || lower(lang) || ' ' || doc_id END AS titulo,
  CASE WHEN doc_id % 13 <> 0 THEN {_unlink(_clean(
      "lower(text) || CASE WHEN doc_id % 3 = 0 THEN chr(160) || 'x' || " + _ODD_END
      + " ELSE ' ñandú' END || ' ver http://www.x.com/' || doc_id"))} END AS descripcion,
  CASE doc_id % 7 WHEN 0 THEN '2025-04-' || {_DAY} || 'T08:30:00-04:00'
    WHEN 1 THEN '2025-04-' || {_DAY} || 'T10:15:00'
    WHEN 2 THEN {_DAY} || ' de abril de 2025'
    WHEN 3 THEN '2025-04-' || {_DAY} || 'T00:00:00'
    WHEN 5 THEN '{_AS_OF}T10:15:00'
    WHEN 6 THEN '2025-04-' || {_DAY} || 'T08:30:00.500000+00:00' END AS fecha,
  CASE WHEN doc_id % 9 <> 0 THEN lower(lang) END AS seccion,
  CASE WHEN doc_id % 19 <> 0 THEN 'https://eldeber.com.bo/pais/' || md5(text) END AS url,
  CASE WHEN doc_id % 17 <> 0 THEN '2025-04-01T' || lpad(CAST(doc_id * 7919 % 1440 // 60 AS VARCHAR), 2, '0') || ':'
    || lpad(CAST(doc_id * 7919 % 1440 % 60 AS VARCHAR), 2, '0') || ':00.250000' END AS date_saved,
  CASE WHEN doc_id % 7 = 5 AND doc_id % 5 = 0 THEN 'fecha_overflow' WHEN doc_id % 11 <= 1 THEN 'titulo_vacio' END
    AS reason
FROM documents"""

_GOOD = f"SELECT * FROM ({_NORMAL}) WHERE reason IS NULL"

_FIRST = f"""SELECT * FROM ({_GOOD}) WHERE url IS NULL
UNION ALL BY NAME
SELECT * FROM ({_GOOD}) WHERE url IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY url ORDER BY date_saved NULLS LAST, data_id) = 1"""


def _known(condition="true"):
    return f"""SELECT 'https://eldeber.com.bo/pais/' || md5(text) FROM documents
WHERE doc_id % 19 <> 0 AND doc_id IN (SELECT doc_id FROM labels WHERE {condition})"""


_REFINED = "data_id, titulo, descripcion, fecha, seccion, url, date_saved AS date_saved_iso"
# Only the Spanish texts are no ISO dates.
_CONSUMPTION = """titulo,
  CASE WHEN contains(fecha, 'T') THEN CAST(substr(fecha, 1, 10) AS DATE) END AS fecha_noticia,
  CASE WHEN contains(fecha, 'T') THEN substr(fecha, 12, 8) ||
    CASE WHEN contains(fecha, '.') THEN substr(fecha, 20, 7) ELSE '.000000' END END AS hora_noticia,
  seccion, CASE WHEN url IS NOT NULL THEN 'eldeber' END AS fuente, url"""

_CONSUMED = f"SELECT {_CONSUMPTION} FROM ({_FIRST})"

_LIST_SOURCE = "CASE doc_id % 3 WHEN 0 THEN 'eldeber' WHEN 1 THEN 'lostiempos' ELSE 'ahoraelpueblo' END"
_ARTICLE_LINK = """CASE doc_id % 3 WHEN 0 THEN 'https://eldeber.com.bo' WHEN 1 THEN 'https://www.lostiempos.com'
  ELSE 'https://ahoraelpueblo.bo' END || '/n/' || doc_id"""
_LIST_SECTION = """CASE WHEN doc_id % 3 <> 1 THEN 'politica' WHEN doc_id % 2 = 0 THEN lang
  ELSE 'Ultimas Noticias' END"""

_NEWS = """SELECT 'n' || event_id AS titulo,
  CASE WHEN event_id % 11 <> 0 THEN CAST(ts AS DATE) END AS fecha_noticia,
  CASE WHEN event_id % 11 <> 0 THEN strftime(ts, '%H:%M:%S.%f') END AS hora_noticia,
  CASE WHEN event_id % 17 <> 0 THEN event_type || '-' || (user_id % 7) END AS seccion,
  CASE WHEN event_id % 13 <> 0 THEN 'src' || (user_id % 5) END AS fuente,
  'https://x.bo/' || user_id || '/' || event_type AS url
FROM events"""
_REPORT = f"SELECT * FROM ({_NEWS}) WHERE fecha_noticia IS NOT NULL AND hora_noticia IS NOT NULL"
_CHOSEN = f"SELECT * FROM ({_REPORT}) WHERE fuente IS NOT NULL"

# Dotted texts are read month first where the day could be a month; all events fall in January.
_EVENT_DAY = """CASE WHEN event_id % 5 = 2 AND day(ts) <= 12
  THEN make_date(year(ts), day(ts), month(ts)) ELSE CAST(ts AS DATE) END"""
_MICROS = "CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END"

_ENTITIES = [("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]


def _decoded(x):
    for entity, char in _ENTITIES:
        x = f"replace({x}, '{entity}', '{char}')"
    return x


_NAV = "regexp_extract(html, '<nav>(.*?)</nav>', 1)"

_DIRTY = """SELECT event_id,
  CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d') WHEN 1 THEN '2024-02-30' WHEN 2 THEN 'ayer' END
    AS fecha_noticia,
  CASE WHEN event_id % 6 = 0 THEN 'mediodia' ELSE strftime(ts, '%H:%M:%S') END AS hora_noticia
FROM events"""

ORACLE = {
    "articles_per_url_source": f"""SELECT fuente, count(*) AS n
FROM (SELECT {_FUENTE} AS fuente FROM (SELECT url, {_AUTHORITY} AS a FROM ({_URLS})))
WHERE fuente IS NOT NULL GROUP BY fuente ORDER BY n DESC, fuente""",
    "scan_pages": f"SELECT page_id, source, section, page, url FROM ({_CAPTURED}) WHERE status = 200",
    "extract_rules": f"""SELECT sha256({_LIST_SOURCE} || ' ' || {_ARTICLE_LINK}) AS data_id,
  {_LIST_SOURCE} AS source, 'Nota ' || doc_id AS titulo,
  {_strip("text || CASE WHEN doc_id % 3 = 1 THEN '' ELSE ' fin' END")} AS descripcion,
  '2025-04-01 10:15' AS fecha, {_LIST_SECTION} AS seccion, {_ARTICLE_LINK} AS url,
  '2025-04-01T12:00:00' AS date_saved
FROM documents WHERE doc_id % 4 <> 3""",
    "union_sources": f"""SELECT {_LIST_SOURCE} AS source, 'Nota ' || doc_id AS titulo, {_LIST_SECTION} AS seccion,
  {_ARTICLE_LINK} AS url FROM documents WHERE doc_id % 4 <> 3""",
    "selector_fallback": """SELECT page_id, CAST(len(found) AS INTEGER) AS n, array_to_string(found, ' ') AS found
FROM (SELECT page_id, CASE WHEN len(a) > 0 THEN a ELSE b END AS found
      FROM (SELECT page_id, regexp_extract_all(html, '<a href="(/[aA][^"]*)"', 1) AS a,
                   regexp_extract_all(html, '<h1>([^<]*)</h1>', 1) AS b FROM pages))""",
    "html_first_and_all": f"""SELECT page_id,
  {_decoded(f"regexp_extract({_NAV}, '<a href=.([^<>]*).>', 1)")} AS first_link,
  {_decoded(f"array_to_string(regexp_extract_all({_NAV}, '<a [^>]*>([^<]*)</a>', 1), ' ')")} AS all_texts
FROM pages""",
    "default_section": """SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 5 <> 0 THEN lang
  ELSE 'Ultimas Noticias' END AS seccion FROM documents""",
    "section_rule": f"""SELECT page_id, CASE WHEN source = 'lostiempos' THEN regexp_extract(html, 'lang="([a-z]+)"', 1)
  ELSE section END AS seccion FROM ({_CAPTURED})""",
    "required_fields": f"""SELECT page_id, titulo, href
FROM (SELECT page_id, {_strip("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")} AS titulo,
             regexp_extract(html, '<a href="([^"]*)"', 1) AS href
      FROM pages WHERE page_id % 4 NOT IN (0, 1) AND page_id % 6 <> 0)
WHERE titulo <> '' AND href <> ''""",
    "resolve_url": """SELECT page_id, CASE page_id % 7
    WHEN 0 THEN 'https://o.bo/' || link WHEN 1 THEN scheme || '://h.bo/' || link WHEN 2 THEN origin || '/' || link
    WHEN 3 THEN origin || path || '?q=1' WHEN 4 THEN origin || path || query || '#f'
    WHEN 5 THEN origin || folder || 'a/' || link
    ELSE origin || CASE WHEN folder = '/' THEN '/' ELSE regexp_replace(folder, '[^/]+/$', '') END || link
  END AS resolved
FROM (SELECT *, CASE WHEN path = '' THEN '/' ELSE regexp_replace(path, '[^/]*$', '') END AS folder
      FROM (SELECT page_id, regexp_extract(html, '<a href="/([^"]*)"', 1) AS link,
                   regexp_extract(url, '^(https?)', 1) AS scheme,
                   regexp_extract(url, '^https?://[^/?#]*') AS origin,
                   regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) AS path,
                   regexp_extract(url, '(\\?[^#]*)', 1) AS query FROM pages))""",
    "next_page_link": """SELECT 'lostiempos' AS source, CAST(doc_id AS INTEGER) AS page,
  'https://www.lostiempos.com/ultimas-noticias' AS url,
  'https://www.lostiempos.com/ultimas-noticias?page=' || doc_id AS next_url
FROM documents WHERE doc_id % 3 = 1""",
    "provenance_key": "SELECT page_id, sha256('eldeber ' || url) AS data_id FROM pages",
    "articles_per_page": f"""SELECT {_LIST_SOURCE} AS source,
  CASE WHEN doc_id % 3 <> 1 THEN 'politica' END AS section, CAST(doc_id AS INTEGER) AS page,
  CAST(CASE WHEN doc_id % 4 = 3 THEN 0 ELSE 1 END AS BIGINT) AS n_articles FROM documents""",
    "quarantine_counts": f"""SELECT 'refined' AS stage, reason, count(*) AS n FROM ({_NORMAL})
WHERE reason IS NOT NULL GROUP BY reason
UNION ALL
SELECT 'extract', unnest(['titulo_vacio', 'url_vacia']), n
FROM (SELECT count(*) AS n FROM documents WHERE doc_id % 4 <> 3)""",
    "unknown_source": f"""SELECT page_id, source FROM ({_CAPTURED})
WHERE source IS NULL OR source NOT IN ('eldeber', 'lostiempos', 'ahoraelpueblo')""",
    "domain_allowlist": f"SELECT page_id, url FROM ({_HOSTS}) WHERE page_id % 8 IN (0, 1, 3, 4, 5)",
    "page_rejects": f"""SELECT * FROM (SELECT h.url, source, 'pages' AS stage,
  CASE WHEN status <> 200 THEN 'estado_http' WHEN page_id % 8 NOT IN (0, 1, 3, 4, 5) THEN 'dominio_ajeno'
       WHEN source IS NULL OR source = 'otro' THEN 'fuente_desconocida' END AS reason
  FROM ({_CAPTURED}) c JOIN ({_HOSTS}) h USING (page_id)) WHERE reason IS NOT NULL""",
    "list_descriptions": """SELECT CAST(doc_id AS VARCHAR) AS data_id, CASE doc_id % 3
  WHEN 0 THEN 'Uno DOS Nota ' || doc_id WHEN 1 THEN 'a' || doc_id ELSE 'x uno ' || doc_id END AS descripcion
FROM documents""",
    "normalize_text": f"""SELECT doc_id, {_normal(
        "'  ' || text || CASE WHEN doc_id % 3 = 0 THEN chr(160) || chr(28) ELSE ' ' || chr(128512) END")} AS normalized
FROM documents""",
    "null_tokens": "SELECT doc_id, CASE WHEN doc_id % 4 = 3 THEN lang END AS lang FROM documents",
    "join_list_field": f"""SELECT doc_id, {_unlink(_clean("array_to_string(string_split(text, chr(10)), ' ')"))} AS descripcion
FROM documents""",
    "clean_text": f"""SELECT doc_id, {_clean(
        "' ' || text || CASE WHEN doc_id % 3 = 0 THEN chr(160) || 'x' || " + _ODD_END + " ELSE '!' END")} AS cleaned
FROM documents""",
    "remove_links": f"""SELECT doc_id, {_unlink(
        "'www.y.bo/á ' || text || ' ver http://www.x.com/' || doc_id || '?a=(b)|c https://ñ'")} AS cleaned
FROM documents""",
    "clean_description": f"""SELECT doc_id, {_unlink(_clean("t"))} AS descripcion,
  {_clean(_unlink("t"))} AS descripcion_sin_enlaces
FROM (SELECT doc_id, {_normal("text || ' ver http://www.x.com/' || doc_id")} AS t FROM documents)""",
    "to_json_line": """SELECT doc_id, CAST(to_json(struct_pack(source := source,
  descripcion := CASE WHEN doc_id % 3 <> 0 THEN text END)) AS VARCHAR) AS line FROM documents""",
    "first_of_list": """SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN string_split(text, ' ')[1] END AS first_word
FROM documents""",
    "url_authority": f"SELECT page_id, {_AUTHORITY} AS authority FROM ({_URLS})",
    "source_from_url": f"""SELECT page_id, {_FUENTE} AS fuente
FROM (SELECT page_id, url, {_AUTHORITY} AS a FROM ({_URLS}))""",
    "parse_fecha": f"""SELECT event_id, CASE event_id % 5
    WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || {_MICROS}
    WHEN 1 THEN strftime(ts, '%Y-%m-%dT00:00:00')
    WHEN 2 THEN CAST({_EVENT_DAY} AS VARCHAR) || strftime(ts, 'T%H:%M:00')
    WHEN 3 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '-04:00'
    ELSE day(ts) || ' de enero de ' || year(ts) END AS fecha FROM events""",
    "split_date_time": f"""SELECT event_id, CASE WHEN event_id % 5 <> 4 THEN {_EVENT_DAY} END AS fecha_noticia,
  CASE event_id % 5 WHEN 0 THEN strftime(ts, '%H:%M:%S.%f') WHEN 1 THEN '00:00:00.000000'
    WHEN 2 THEN strftime(ts, '%H:%M:00.000000') WHEN 3 THEN strftime(ts, '%H:%M:%S.000000') END AS hora_noticia
FROM events""",
    "date_saved_iso": f"""SELECT event_id, CASE event_id % 4
    WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || {_MICROS} WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
    WHEN 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:00-04:00') END AS date_saved_iso FROM events""",
    "coerce_time": """SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%H:%M:%S.%g000')
  WHEN 1 THEN strftime(ts, '%H:%M:%S.000000') END AS hora_noticia FROM events""",
    "coerce_date": f"SELECT event_id, TRY_CAST(fecha_noticia AS DATE) AS fecha_noticia FROM ({_DIRTY})",
    "coercion_loss": f"""SELECT count(*) AS n_lost FROM ({_DIRTY})
WHERE fecha_noticia IS NOT NULL AND (event_id % 4 <> 0 OR hora_noticia = 'mediodia')""",
    "landing_roundtrip": f"""SELECT 'D-' || doc_id AS data_id, source,
  CASE doc_id % 11 WHEN 0 THEN chr(160) || ' ' WHEN 1 THEN ' Null ' ELSE '  Nota ' || lang || ' ' || doc_id END AS titulo,
  CASE WHEN doc_id % 13 = 0 THEN ' ' ELSE text || CASE WHEN doc_id % 3 = 0 THEN chr(160) || 'x' || {_ODD_END} ELSE ' Ñandú' END
    || ' ver http://www.x.com/' || doc_id END AS descripcion,
  CASE doc_id % 7 WHEN 0 THEN '2025-04-' || {_DAY} || 'T08:30:00-04:00' WHEN 1 THEN '04/' || {_DAY} || '/2025 10:15'
    WHEN 2 THEN {_DAY} || ' de abril de 2025' WHEN 3 THEN {_DAY} || ' Apr 2025' WHEN 4 THEN ''
    WHEN 5 THEN CASE WHEN doc_id % 5 = 0 THEN '99999999999999999999' ELSE '10:15' END
    ELSE '2025-04-' || {_DAY} || ' 08:30:00.5Z' END AS fecha,
  CASE WHEN doc_id % 9 = 0 THEN ' Null ' ELSE upper(lang) END AS seccion,
  CASE WHEN doc_id % 19 = 0 THEN '' WHEN doc_id % 2 = 0 THEN upper('https://Eldeber.com.bo/pais/' || md5(text)) || chr(160)
    ELSE 'https://Eldeber.com.bo/pais/' || md5(text) END AS url,
  CASE WHEN doc_id % 17 = 0 THEN 'ayer' ELSE '2025-04-01T' || lpad(CAST(doc_id * 7919 % 1440 // 60 AS VARCHAR), 2, '0')
    || ':' || lpad(CAST(doc_id * 7919 % 1440 % 60 AS VARCHAR), 2, '0') || ':00.25' END AS date_saved,
  '20261201_000000' AS run_ts
FROM documents""",
    "title_required": f"SELECT data_id, titulo FROM ({_NORMAL}) WHERE titulo IS NOT NULL",
    "refined_projection": f"SELECT {_REFINED} FROM ({_GOOD})",
    "consumption_projection": f"SELECT {_CONSUMPTION} FROM ({_GOOD})",
    "dedupe_first_wins": f"SELECT data_id, titulo, url, date_saved FROM ({_FIRST})",
    "dedupe_against_history": f"""SELECT {_REFINED} FROM ({_FIRST})
WHERE url IS NULL OR url NOT IN ({_known()})""",
    "known_articles": f"SELECT data_id, url FROM ({_GOOD}) WHERE url IN ({_known()})",
    "upsert_do_nothing": f"""SELECT {_CONSUMPTION} FROM ({_FIRST})
WHERE url IS NULL OR url NOT IN ({_known('quality = 1')})""",
    "consumption_backfill": f"""SELECT {_CONSUMPTION} FROM ({_FIRST})
WHERE CASE WHEN url IS NULL THEN doc_id % 3 = 2 ELSE url NOT IN ({_known('quality = 1')}) END""",
    "stream_refine": f"SELECT {_REFINED} FROM ({_FIRST})",
    "stream_upsert_idempotent": f"{_CONSUMED} UNION ALL {_CONSUMED} WHERE url IS NULL",
    "stream_available_now": _CONSUMED,
    "load_report": _REPORT,
    "filter_sources": f"SELECT * FROM ({_REPORT}) WHERE fuente IN ('src1', 'src3')",
    "filter_date_range": f"""SELECT * FROM ({_REPORT})
WHERE fecha_noticia >= DATE '2024-01-10' AND fecha_noticia <= DATE '2024-01-19'""",
    "filter_last_30_days": f"""SELECT * FROM ({_REPORT})
WHERE fecha_noticia >= DATE '2024-01-25' - 30 AND fecha_noticia <= DATE '2024-01-25'""",
    "articles_per_day": f"""SELECT fecha_noticia, count(DISTINCT url) AS n FROM ({_CHOSEN})
GROUP BY fecha_noticia ORDER BY fecha_noticia""",
    "articles_per_source": f"""SELECT fuente, count(*) AS n FROM ({_REPORT}) WHERE fuente IS NOT NULL
GROUP BY fuente ORDER BY n DESC, fuente""",
    "top10_sections": f"""SELECT seccion, count(*) AS n FROM ({_CHOSEN}) WHERE seccion IS NOT NULL
GROUP BY seccion ORDER BY n DESC, seccion LIMIT 10""",
    "filtered_total": f"SELECT count(*) AS total FROM ({_CHOSEN})",
    "distinct_sources": f"SELECT DISTINCT fuente FROM ({_REPORT}) WHERE fuente IS NOT NULL ORDER BY fuente",
    "date_bounds": f"SELECT min(fecha_noticia) AS fecha_min, max(fecha_noticia) AS fecha_max FROM ({_REPORT})",
    "has_values": f"""SELECT count(fuente) > 0 AS has_fuente, count(fecha_noticia) > 0 AS has_fecha_noticia
FROM ({_REPORT})""",
    "latest_20": f"""SELECT titulo, fecha_noticia, hora_noticia, seccion, fuente, url FROM ({_CHOSEN})
ORDER BY fecha_noticia DESC, hora_noticia DESC, url LIMIT 20""",
}
ORACLE["stream_watermark_dedupe"] = f"""SELECT url, CASE WHEN url IS NULL THEN count(*)
  ELSE count(*) FILTER (date_saved IS NULL) + CAST(count(date_saved) > 0 AS BIGINT) END AS n FROM ({_GOOD}) GROUP BY url"""
ORACLE["stream_archived_landing"] = f"""SELECT data_id, descripcion,
  CASE WHEN odd THEN '20261201_000000' ELSE '20261203_000000' END AS run_ts,
  CASE WHEN odd THEN 'archive' ELSE 'landing' END AS folder
FROM (SELECT *, CAST(regexp_extract(data_id, '[0-9]+') AS BIGINT) % 2 = 1 AS odd FROM ({ORACLE["landing_roundtrip"]}))"""
# The extracts of a report, read back from their files.
for _extract, _query in [("total", "filtered_total"), ("per_day", "articles_per_day"), ("top_sections", "top10_sections"),
                         ("latest", "latest_20"), ("per_source", "articles_per_source")]:
    ORACLE[f"extract_{_extract}"] = ORACLE[_query]

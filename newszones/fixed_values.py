"""Fixed values. Results depend on these exact texts, so they stand here as plain data."""

# Domains whose pages may be crawled.
ALLOWED_DOMAINS = ["eldeber.com.bo", "lostiempos.com", "ahoraelpueblo.bo"]

# Domain text looked for inside a URL's authority, in this order, and the source name it gives.
KNOWN_SOURCES = [
    ("eldeber.com.bo", "eldeber"),
    ("lostiempos.com", "lostiempos"),
    ("ahoraelpueblo.bo", "ahoraelpueblo"),
]

# Section of an article whose page names none.
DEFAULT_SECTION = "Ultimas Noticias"

# Texts that stand for a missing value once a field is lower-cased and stripped.
NULL_TOKENS = ["", " ", "null"]

# Code point ranges that count as whitespace: the Unicode set that Python strips and matches as \s.
WHITESPACE_RANGES = [
    (0x09, 0x0D),
    (0x1C, 0x20),
    (0x85, 0x85),
    (0xA0, 0xA0),
    (0x1680, 0x1680),
    (0x2000, 0x200A),
    (0x2028, 0x2029),
    (0x202F, 0x202F),
    (0x205F, 0x205F),
    (0x3000, 0x3000),
]

# Characters a description keeps, and the ones a link may consist of ($-_ is a range).
DESCRIPTION_CHARS = "a-zA-Z0-9"
LINK_CHARS = "a-zA-Z0-9$-_@.&+!*(),"

# Characters that turn into one of / ? # @ : under NFKC; an authority with one of them is invalid.
AUTHORITY_LOOKALIKES = (
    "⁇⁈⁉℀℁℅℆⩴︓︖"
    "﹕﹖﹟﹫＃／：？＠"
)

# Month names a date may use, in lower case; Spanish ones only on request.
MONTHS = {
    1: ["january", "jan"],
    2: ["february", "feb"],
    3: ["march", "mar"],
    4: ["april", "apr"],
    5: ["may"],
    6: ["june", "jun"],
    7: ["july", "jul"],
    8: ["august", "aug"],
    9: ["september", "sept", "sep"],
    10: ["october", "oct"],
    11: ["november", "nov"],
    12: ["december", "dec"],
}
SPANISH_MONTHS = {
    1: ["enero", "ene"],
    2: ["febrero", "feb"],
    3: ["marzo", "mar"],
    4: ["abril", "abr"],
    5: ["mayo", "may"],
    6: ["junio", "jun"],
    7: ["julio", "jul"],
    8: ["agosto", "ago"],
    9: ["septiembre", "setiembre", "sep", "set"],
    10: ["octubre", "oct"],
    11: ["noviembre", "nov"],
    12: ["diciembre", "dic"],
}
WEEKDAYS = [
    "monday", "mon", "tuesday", "tue", "wednesday", "wed", "thursday", "thu",
    "friday", "fri", "saturday", "sat", "sunday", "sun",
]

# Report constants.
TOP_SECTIONS = 10
SAMPLE_ROWS = 20
FALLBACK_DAYS = 30
REPORT_COLUMNS = ["titulo", "fecha_noticia", "hora_noticia", "seccion", "fuente", "url"]

# Where each source's list pages hold their articles. Per source: the row selectors (a later one
# is used only if the earlier ones match nothing) and, per field, the selectors in the same manner,
# whether the first match or all matches count, and the default.
SELECTORS = {
    "eldeber": {
        "rows": ['//div[contains(@class, "titulo-teaser-2col")]/a/h2/ancestor::article'],
        "fields": {
            "titulo": (['.//div[contains(@class, "titulo-teaser-2col")]/a/h2/text()'], "first", ""),
            "descripcion": (['.//div[contains(@class, "entradilla-teaser-2col")]//text()'], "all", ""),
            "fecha": (['.//div[contains(@class, "fecha-teaser-2col")]/div/time/text()'], "first", ""),
            "url": (['.//div[contains(@class, "titulo-teaser-2col")]/a/@href'], "first", ""),
        },
    },
    "lostiempos": {
        "rows": ['//section[contains(@class, "pane-views-panes")]//div[contains(@class, "views-row")]'],
        "fields": {
            "titulo": (['.//div[contains(@class, "views-field-title term")]/a/text()'], "first", ""),
            "descripcion": (
                ['.//div[contains(@class, "views-field-field-noticia-sumario")]/span/text()'], "first", ""),
            "fecha": (['.//span[contains(@class, "views-field-field-noticia-fecha")]/span/text()'], "first", ""),
            "seccion": (
                ['.//span[contains(@class, "views-field-seccion")]/span/a/text()'], "first", "Ultimas Noticias"),
            "url": (['.//div[contains(@class, "views-field-title term")]/a/@href'], "first", ""),
        },
        "next_page": '//li[contains(@class, "pager-next")]/a/@href',
    },
    "ahoraelpueblo": {
        "rows": [
            '//div[@class="article-list"]//div[@itemprop="blogPost"]',
            '//*[@id="sp-component"]/div/div[2]/div[2]/div/div/div',
        ],
        "fields": {
            "titulo": (['.//h2[@itemprop="name"]/a/text()', ".//div[2]/div[1]/h2/a/text()"], "first", ""),
            "descripcion": (
                ['.//div[@itemprop="description"]//text()',
                 './/div[contains(@class, "article-introtext")]//text()'], "all", ""),
            "fecha": (['.//time[@itemprop="datePublished"]/@datetime', ".//time/@datetime"], "first", None),
            "url": (['.//h2[@itemprop="name"]/a/@href', ".//div[2]/div[1]/h2/a/@href"], "first", None),
        },
    },
}

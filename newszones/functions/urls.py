"""URL parts, link resolution and source names as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from newszones import fixed_values as fixed

_LEADING = "".join(chr(c) for c in range(0x21))
_SCHEME = r"^([a-zA-Z][a-zA-Z0-9+.\-]*):"
# RFC 3986, appendix B; the groups are scheme, authority, path, query, fragment.
_PARTS = r"^(?:([a-zA-Z][a-zA-Z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
_IPV6 = r"^(?:[^\[\]]*@)?\[[0-9a-fA-F:.]*:[0-9a-fA-F:.]*(?:%[^\[\]]*)?\](?::[^\[\]]*)?$"


def _tidy(url: Column) -> Column:
    """Leading control characters and blanks, and any tab or line break, are not part of a URL."""
    return F.translate(F.ltrim(url, F.lit(_LEADING)), "\t\r\n", "")


def _authority_text(url: Column) -> Column:
    return F.regexp_extract(_tidy(url), r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)", 1)


def url_authority(url: Column) -> Column:
    """Authority of a URL: ``''`` if it has none, NULL if it is malformed."""
    authority = _authority_text(url)
    brackets = authority.contains("[") | authority.contains("]")
    invalid = (brackets & ~authority.rlike(_IPV6)) | authority.rlike(f"[{fixed.AUTHORITY_LOOKALIKES}]")
    return F.when(~invalid, authority)


def url_host(url: Column) -> Column:
    """Host name in lower case, without user info and port."""
    return F.lower(F.regexp_replace(url_authority(url), r"^.*@|:[^:\]]*$", ""))


def on_allowed_domain(url: Column, domains: list[str] | None = None) -> Column:
    """Whether the host is one of the domains or a subdomain of one."""
    host = url_host(url)
    allowed = F.lit(False)
    for domain in domains if domains is not None else fixed.ALLOWED_DOMAINS:
        allowed = allowed | (host == domain) | host.endswith("." + domain)
    return F.coalesce(allowed, F.lit(False))


def source_from_url(url: Column) -> Column:
    """Source name of a URL.

    A known domain anywhere in the authority decides. Else it is the last label but one, or the first
    label if that is ``com``, or the authority itself if it has a single label.
    """
    authority = url_authority(url)
    labels = F.split(authority, "[.]")
    last_but_one = F.try_element_at(labels, F.lit(-2))
    name = F.when(authority.isNull() | (url == ""), F.lit(None).cast("string"))
    for domain, source in fixed.KNOWN_SOURCES:
        name = name.when(authority.contains(domain), source)
    return name.when(last_but_one == "com", F.get(labels, F.lit(0))).otherwise(
        F.coalesce(last_but_one, authority))


def _without_dot_segments(path: Column) -> Column:
    segments = F.split(path, "/")
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, seg: F.when(seg == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(seg == ".", acc)
        .otherwise(F.concat(acc, F.array(seg))),
    )
    ends_in_dots = F.element_at(segments, -1).isin(".", "..")
    joined = F.array_join(F.when(ends_in_dots, F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")
    return F.when(path.rlike(r"(?:^|/)\.\.?(?:/|$)"), F.when(joined == "", "/").otherwise(joined)).otherwise(path)


def resolve_url(base: Column, href: Column) -> Column:
    """Resolve a link found on the page ``base`` (an ``http`` or ``https`` URL)."""
    link, page = _tidy(href), _tidy(base)

    def part(url, group):
        return F.regexp_extract(url, _PARTS, group)

    page_scheme = F.lower(part(page, 1))
    link_scheme = F.lower(part(link, 1))
    foreign = (link_scheme != "") & (link_scheme != page_scheme)
    has_authority = part(link, 2) != ""
    path = part(link, 3)
    relative = ~path.startswith("/")
    folder = F.regexp_extract(part(page, 3), "^(.*/)", 1)
    merged = F.when(
        relative, F.regexp_replace(F.concat(F.when(folder == "", "/").otherwise(folder), path), "/{2,}", "/")
    ).otherwise(path)
    own_path = F.when(path == "", part(page, 3)).otherwise(_without_dot_segments(merged))
    final_path = F.when(has_authority, path).otherwise(own_path)
    rooted = F.when((final_path == "") | final_path.startswith("/"), final_path).otherwise(
        F.concat(F.lit("/"), final_path))
    query = F.when(~has_authority & (path == "") & (part(link, 4) == ""), part(page, 4)).otherwise(part(link, 4))
    fragment = part(link, 5)
    resolved = F.concat(
        page_scheme, F.lit("://"),
        F.when(has_authority, part(link, 2)).otherwise(part(page, 2)),
        rooted,
        F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)),
        F.when(fragment == "", "").otherwise(F.concat(F.lit("#"), fragment)),
    )
    return F.when(href == "", base).when(foreign, href).otherwise(resolved)

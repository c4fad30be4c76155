"""Articles out of captured list pages.

Python only turns a page into lists of matched texts, per block and selector. Which selector counts, first
or all matches, defaults, required fields, links and stamps are column expressions on those lists.
"""

from collections.abc import Iterator
from html import escape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newszones import fixed_values as fixed
from newszones import schemas
from newszones.functions.dates import iso_text
from newszones.functions.text import join_list, strip
from newszones.functions.urls import resolve_url
from newszones.operators.html_tree import Tree, compile_selector, select
from newszones.operators.rules import NEXT_PAGE, collect_rules

FIELDS = ["titulo", "descripcion", "fecha", "seccion", "url"]
#: Markup whose finds a worker holds as Python objects at once.
PIECE_CHARS = 1 << 20

_TEXTS = pa.list_(pa.string())
_FOUND = pa.struct([
    ("blocks", pa.list_(pa.list_(_TEXTS))),
    ("next_pages", _TEXTS),
    ("faults", pa.list_(pa.struct([("place", pa.int32()), ("error", pa.string()), ("markup", pa.string())]))),
    ("error", pa.string()),
    ("markup", pa.string()),
])
_FOUND_DDL = ("blocks array<array<array<string>>>, next_pages array<string>, "
              "faults array<struct<place: int, error: string, markup: string>>, error string, markup string")


def _plans(rules: list, slots: list[tuple[str, int]]) -> dict:
    """Per source: row selectors in order, each slot's selector, and the next-page selectors."""
    plans = {}
    for rule in sorted(rules, key=lambda r: (r["source"], r["row_order"], r["fallback_order"])):
        plan = plans.setdefault(rule["source"], {"rows": {}, "slots": {}, "next": []})
        steps = compile_selector(rule["selector"])
        if rule["field"] == NEXT_PAGE:
            plan["next"].append(steps)
            continue
        plan["rows"].setdefault(rule["row_order"], compile_selector(rule["row_selector"]))
        plan["slots"][slots.index((rule["field"], rule["fallback_order"]))] = steps
    return plans


def _markup(tree: Tree, node: int) -> str:
    """An element as it was understood."""
    out, opened = [], []
    for n in range(node, tree.ends[node]):
        while opened and tree.ends[opened[-1]] <= n:
            out.append(f"</{tree.tags[opened.pop()]}>")
        if tree.tags[n] is None:
            out.append(escape(tree.values[n], quote=False))
        else:
            out.append(f"<{tree.tags[n]}" + "".join(f' {k}="{escape(v)}"' for k, v in tree.values[n].items()) + ">")
            opened.append(n)
    return "".join(out + [f"</{tree.tags[n]}>" for n in reversed(opened)])


def _finder(plans: dict, n_slots: int):
    def find(html, source):
        plan = plans[source]
        tree = Tree(html)
        blocks = next((b for steps in plan["rows"].values() if (b := select(tree, 0, steps))), [])
        next_pages = next((p for steps in plan["next"] if (p := select(tree, 0, steps))), [])
        found, faults = [], []
        for place, block in enumerate(blocks):
            try:
                found.append([select(tree, block, plan["slots"][k]) if k in plan["slots"] else [] for k in range(n_slots)])
            except Exception as e:  # a block that cannot be read goes to quarantine, the others of its page do not
                found.append([[] for _ in range(n_slots)])
                faults.append({"place": place, "error": f"{type(e).__name__}: {e}", "markup": _markup(tree, block)})
        return {"blocks": found, "next_pages": next_pages, "faults": faults, "error": None, "markup": None}

    @F.arrow_udf(_FOUND_DDL)
    def found(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for html, source in batches:
            yield from _in_pieces(find, html, source)

    return found


def _in_pieces(find, htmls: pa.Array, sources: pa.Array) -> Iterator[pa.Array]:
    """What ``find`` gives for each page, in arrays of about ``PIECE_CHARS`` of markup, however large the batch is."""
    out, size = [], 0
    for html, source in zip(htmls, sources):
        html = html.as_py()
        try:
            out.append(find(html or "", source.as_py()))
        except Exception as e:  # one bad page must not end the job; it goes to quarantine
            out.append({"blocks": [], "next_pages": [], "faults": [], "error": f"{type(e).__name__}: {e}", "markup": html})
        size += len(html or "") + 1
        if size >= PIECE_CHARS:
            yield pa.array(out, _FOUND)
            out, size = [], 0
    if out:
        yield pa.array(out, _FOUND)


def first_filled(*lists: Column) -> Column:
    """The first list with any element, else an empty one. Blank elements count."""
    chosen = F.lit(None).cast("array<string>")
    for candidate in reversed(lists):
        chosen = F.when(F.size(candidate) > 0, candidate).otherwise(chosen)
    return F.coalesce(chosen, F.array().cast("array<string>"))


def first_match(found: Column, default: Column | None = None) -> Column:
    """First element, or the default if there is none; a blank element is a match."""
    first = F.try_element_at(found, F.lit(1))
    return first if default is None else F.coalesce(first, default)


def all_matches(found: Column) -> Column:
    return join_list(found)


def with_default_section(section: Column) -> Column:
    """The default for a missing section; a blank one stays blank."""
    return F.coalesce(section, F.lit(fixed.DEFAULT_SECTION))


def section_rule(source: Column, from_page: Column, from_crawl: Column) -> Column:
    """Only pages of the second source name each article's section; the crawl knows it for the others."""
    return F.when(source == "lostiempos", from_page).otherwise(from_crawl)


def missing_field(titulo: Column, href: Column) -> Column:
    """Why an extracted article is incomplete, NULL if it is not."""
    return F.when(F.coalesce(titulo, F.lit("")) == "", "titulo_vacio").when(
        F.coalesce(href, F.lit("")) == "", "url_vacia")


def provenance_key(source: Column, url: Column) -> Column:
    """A stable article id, so that a replay gives the same rows."""
    return F.sha2(F.concat_ws(" ", source, url), 256)


def unknown_sources(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Pages of sources no rule exists for."""
    sources = sorted({r["source"] for r in collect_rules(rules)})
    return pages.filter(F.col("source").isNull() | ~F.col("source").isin(sources))


def with_matches(pages: DataFrame, rules: DataFrame | list) -> DataFrame:
    """Pages of known sources with a struct column ``found``: blocks, next-page links, faults, error.

    Blocks hold one list per (field, fallback order), as ``slots_of`` numbers them; a block that raised is listed among the
    faults, an unreadable page has an error, both with their markup. The rules are bounded
    configuration and travel in the function itself; the page table is neither joined nor shuffled.
    """
    rows = collect_rules(rules)
    slots = slots_of(rows)
    sources = sorted({r["source"] for r in rows})
    find = _finder(_plans(rows, slots), len(slots))
    return pages.filter(F.col("source").isin(sources)).withColumn("found", find("html", "source")).drop("html")


def slots_of(rules: list) -> list[tuple[str, int]]:
    return sorted({(r["field"], r["fallback_order"]) for r in rules if r["field"] != NEXT_PAGE})


def extract_blocks(pages: DataFrame, rules: DataFrame, keep_empty_pages: bool = False) -> DataFrame:
    """One row per article block with its raw fields, its place on the page, and a reject ``reason``.

    A page without blocks gives no row, or one with a NULL ``position`` if such pages are to be kept.
    """
    rows = collect_rules(rules)
    slots = slots_of(rows)
    settings = {(r["source"], r["field"]): (r["mode"], r["default"]) for r in rows if r["field"] != NEXT_PAGE}
    blocks = (
        with_matches(pages, rows)
        .select("*", F.posexplode_outer("found.blocks").alias("position", "block"))
    )
    if not keep_empty_pages:
        blocks = blocks.filter(F.col("block").isNotNull() | F.col("found.error").isNotNull())
    page_url = F.col("url")
    fields = {}
    for field in FIELDS:
        found = first_filled(*[
            F.get("block", F.lit(k)) for k, (name, _) in enumerate(slots) if name == field])
        # One branch per way of reading the field, with the sources that use it.
        ways = {}
        for (source, name), way in sorted(settings.items()):
            if name == field:
                ways.setdefault(way, []).append(source)
        value = F.lit(None).cast("string")
        for (mode, default), used_by in ways.items():
            # A field whose default is a text is stripped; links never are.
            text = all_matches(found) if mode == "all" else first_match(
                found, None if default is None else F.lit(default))
            if field != "url" and (default is not None or field == "titulo"):
                text = strip(text)
            value = F.when(F.col("source").isin(used_by), text).otherwise(value)
        fields[field] = value
    has_section = sorted({s for s, name in settings if name == "seccion"})
    fault = F.get(F.filter("found.faults", lambda x: x["place"] == F.col("position")), F.lit(0))
    return blocks.select(
        "source", "section", "page", page_url.alias("page_url"), "captured_at", "position",
        F.col("found.error").alias("page_error"), F.coalesce("found.error", fault["error"]).alias("error"),
        F.coalesce("found.markup", fault["markup"]).alias("markup"),
        fields["titulo"].alias("titulo"),
        fields["descripcion"].alias("descripcion"),
        fields["fecha"].alias("fecha"),
        F.when(F.col("source").isin(has_section), fields["seccion"]).otherwise(F.col("section")).alias("seccion"),
        fields["url"].alias("href"),
    ).withColumn("reason", F.when(F.col("page_error").isNotNull(), "pagina_ilegible").when(
        F.col("error").isNotNull(), "bloque_ilegible").otherwise(missing_field(F.col("titulo"), F.col("href")))).drop("page_error")


#: Reasons for which a block or page is rejected.
BLOCK_REASONS = ["pagina_ilegible", "bloque_ilegible", "titulo_vacio", "url_vacia"]


def landing_rows(blocks: DataFrame) -> DataFrame:
    """Complete blocks as landing rows.

    ``date_saved`` is the capture time plus one microsecond per block, which keeps the order in which
    the articles of a page are read.
    """
    url = resolve_url(F.col("page_url"), F.col("href"))
    saved = F.timestamp_add("MICROSECOND", F.col("position"), F.col("captured_at"))
    return (
        blocks.filter(F.col("reason").isNull())
        .withColumn("url", url)
        .withColumn("data_id", provenance_key(F.col("source"), F.col("url")))
        .withColumn("date_saved", iso_text(saved))
        .select(*schemas.LANDING_FIELDS)
    )


def rejected_blocks(blocks: DataFrame) -> DataFrame:
    """Incomplete blocks and unreadable pages in the shape of the quarantine table."""
    return blocks.filter(F.col("reason").isNotNull()).select(
        F.lit(None).cast("string").alias("data_id"), "source", "titulo", "descripcion", "fecha", "seccion",
        F.coalesce(F.nullif("href", F.lit("")), "page_url").alias("url"),
        iso_text(F.col("captured_at")).alias("date_saved"),
        F.lit("extract").alias("stage"), "reason", "error", F.col("markup").alias("_corrupt_record"))


def extract_articles(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Landing rows of all captured pages of known sources."""
    return landing_rows(extract_blocks(pages, rules))


def next_page_links(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """The link to the next list page, per page that has one."""
    return (
        with_matches(pages, rules)
        .select("source", "page", "url", F.try_element_at("found.next_pages", F.lit(1)).alias("href"))
        .filter(F.col("href").isNotNull() & (F.col("href") != ""))
        .select("source", "page", "url", resolve_url(F.col("url"), F.col("href")).alias("next_url"))
    )


def articles_per_page(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Complete articles per page; a page without any is reported with 0."""
    return extract_blocks(pages, rules, keep_empty_pages=True).groupBy("source", "section", "page").agg(
        F.count_if(F.col("reason").isNull()).alias("n_articles"))

"""Source divergence audit: how far the sources of one language lie apart, and by which terms.

Per language and source, each kept term has a smoothed share ``p`` in billionths; two distributions differ by the sum of
``(p - q)^2 / q`` over all kept terms, rounded down for each term. All arithmetic is exact.

1. *Collapse.* Identical texts of a language become one row with the number of rows that each source has of it, so a text
   that a third of all rows share is split into terms once. Counts of equal rows are added before any shuffle.
2. *Terms.* Every distinct text is split once; a term adds the text's copies to its document frequency, and occurrences
   times copies to the source's count. Tasks add up what they have seen and pass it on in bounded lots.
3. *Sparse pairs.* A term that neither of two sources has adds the same number for all such terms; one that only one of
   them has adds a number that depends on its share there, so a histogram of shares is enough. Only for terms that both
   have are the two shares looked at together: a task holds one term's sources at a time and adds up per pair.

Null language, source and text count as empty. A language whose terms are all rare has no kept term: its pairs have the
value 0, and it has no term rows. Repeated rows count as often as they are there. Very long texts are split whole. An empty
table gives no rows. Other columns are not looked at.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newszones.operators.dedupe import broadcast_if_small
from newszones.sources.storage import work_path, write_and_read

MIN_DOCS = 3
TOP_TERMS = 200
BILLION = 1_000_000_000
#: Terms that a task holds before it passes them on, and pairs of sources that it looks at together.
LOT_TERMS = 1_000_000
LOT_PAIRS = 1 << 20
#: Bytes to bytes: A-Z to a-z, a-z and what is beyond ASCII unchanged, the rest to spaces.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_TERM_ROWS = pa.schema([("lang", pa.string()), ("term", pa.string()), ("source", pa.string()), ("n", pa.int64())])
_PAIR_ROWS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("part", pa.int64())])


def collapse(docs: DataFrame) -> DataFrame:
    """``lang, text, places``: each distinct text of a language, with ``source, n`` of the sources that have it."""
    empty = F.lit("")
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), empty).alias(c) for c in ("lang", "source", "text")])
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    places = (rows.groupBy("lang", "digest", "source").agg(F.count("*").alias("n"))
              .groupBy("lang", "digest").agg(F.collect_list(F.struct("source", "n")).alias("places")))
    texts = rows.groupBy("lang", "digest").agg(F.first("text").alias("text"))
    return texts.join(places, ["lang", "digest"]).select("lang", "text", "places")


def _term_lots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of what a lot of texts adds: rows with a source are counts, rows without one document frequencies."""
    counts: dict[tuple[str, str | None], Counter] = {}

    def lots():
        for (lang, source), terms in counts.items():
            names = list(terms)
            for at in range(0, len(names), 1 << 16):
                own = names[at:at + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(own), pa.string()), pa.array(own, pa.binary()).cast(pa.string()),
                     pa.array([source] * len(own), pa.string()), pa.array([terms[x] for x in own], pa.int64())],
                    schema=_TERM_ROWS)
        counts.clear()

    for batch in batches:
        langs, texts, places = batch.columns
        for k in range(len(batch)):
            lang, own = langs[k].as_py(), texts[k].as_py().translate(TERM_BYTES).split()
            if not own:
                continue
            where = places[k].as_py()
            copies = sum(p["n"] for p in where)
            if copies == 1:
                counts.setdefault((lang, None), Counter()).update(set(own))
                counts.setdefault((lang, where[0]["source"]), Counter()).update(own)
            else:
                for source, times in [(None, copies), *((p["source"], p["n"]) for p in where)]:
                    into = counts.setdefault((lang, source), Counter())
                    for term, n in Counter(own).items():
                        into[term] += times if source is None else times * n
            if sum(map(len, counts.values())) > LOT_TERMS:
                yield from lots()
    yield from lots()


def kept_terms(texts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, term, places``: terms in at least ``min_docs`` documents, with ``source, n`` of the sources that have them."""
    seen = texts.select("lang", F.col("text").cast("binary").alias("text"), "places").mapInArrow(
        _term_lots, "lang string, term string, source string, n long")
    # Tasks have added up their own; dealt by term, the sums per source and those per term need one shuffle.
    sums = seen.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"))
    place = F.when(F.col("source").isNotNull(), F.struct("source", "n"))
    return (sums.groupBy("lang", "term").agg(
                F.max(F.when(F.col("source").isNull(), F.col("n"))).alias("docs"), F.collect_list(place).alias("places"))
            .filter(F.col("docs") >= min_docs).select("lang", "term", "places"))


def share(count: Column, total: Column) -> Column:
    """``1 + floor(10^9 (count + 1) / total)``, exact for counts of any size."""
    whole = (count.cast("decimal(20,0)") + F.lit(1)) * F.lit(BILLION).cast("decimal(10,0)")
    large = F.call_function("div", whole, total.cast("decimal(20,0)")).cast("long")
    small = F.call_function("div", (F.least(count, F.lit(BILLION)) + 1) * F.lit(BILLION), total)
    return F.when(count < BILLION, small).otherwise(large) + 1


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _groups(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``lang, source, total, lang_total, p0``: of every group the denominators and the share of a term it lacks."""
    there = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    counted = (terms.select("lang", F.inline("places")).groupBy("lang", "source").agg(F.sum("n").alias("count")))
    kept = terms.groupBy("lang").agg(F.count("*").alias("kept"))
    groups = there.join(counted, ["lang", "source"], "left").join(kept, "lang", "left").na.fill(0, ["count", "kept"])
    lang_count = F.sum("count").over(Window.partitionBy("lang"))
    return groups.select(
        "lang", "source", "kept", (F.col("count") + F.col("kept")).alias("total"),
        (lang_count + F.col("kept")).alias("lang_total"),
        F.when(F.col("kept") > 0, share(F.lit(0), F.col("count") + F.col("kept"))).alias("p0"))


def _pair_lots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For terms that two sources have: what is to be added to the sums that take the sources one by one.

    Terms with equally many sources are taken together, at most ``LOT_PAIRS`` pairs at once. Sums are kept modulo 2^64, as the
    final value fits a long.
    """
    def far(x, y):
        return (x - y) ** 2 // y

    def lot(lang, names, codes, more):
        """Sums per pair, from the pairs' codes."""
        n = len(names)
        if n * n <= LOT_PAIRS:
            table = np.zeros(n * n, np.int64)
            np.add.at(table, codes, more)
            codes = np.flatnonzero(table)
            more = table[codes]
        else:
            order = np.argsort(codes, kind="stable")
            codes, first = np.unique(codes[order], return_index=True)
            more = np.add.reduceat(more[order], first)
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(codes), pa.string()), names.take(pa.array(codes // n)), names.take(pa.array(codes % n)),
             pa.array(more)], schema=_PAIR_ROWS)

    for batch in batches:
        langs, places = batch.column(0).dictionary_encode(), batch.column(1)
        starts = places.offsets.to_numpy()
        sizes, of = np.diff(starts), langs.indices.to_numpy()
        where = places.values
        sources = where.field("source").dictionary_encode()
        names, code = sources.dictionary, sources.indices.to_numpy().astype(np.int64)
        p, p0 = (where.field(c).to_numpy() for c in ("p", "p0"))
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            for size in np.unique(sizes[of == k]).tolist():
                rows = starts[:-1][(of == k) & (sizes == size)]
                wide = max(1, min(size, LOT_PAIRS // size))
                deep = max(1, LOT_PAIRS // (size * wide))
                for at in range(0, len(rows), deep):
                    every = rows[at:at + deep, None] + np.arange(size)
                    for left in range(0, size, wide):
                        some = every[:, left:left + wide]
                        a, a0, b, b0 = p[some][:, :, None], p0[some][:, :, None], p[every][:, None], p0[every][:, None]
                        pairs = code[some][:, :, None] * len(names) + code[every][:, None]
                        with np.errstate(over="ignore"):
                            more = far(a, b) - far(a, b0) - far(a0, b) + far(a0, b0)
                            yield lot(lang, names, *(x[some[:, :, None] != every[:, None]] for x in (pairs, more)))


def _near(rows: DataFrame, groups: DataFrame, on) -> DataFrame:
    """``rows`` with their group's numbers; the groups are broadcast if their measured size allows it."""
    small = broadcast_if_small(groups)
    return rows.join(groups if small is None else small, on)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank`` over ``lang, source, text`` of ``docs``."""
    spark = docs.sparkSession
    terms = write_and_read(kept_terms(collapse(docs), min_docs), work_path(spark, "audit_terms"))
    groups = write_and_read(_groups(docs, terms), work_path(spark, "audit_groups"))

    in_lang = F.aggregate("places", F.lit(0).cast("long"), lambda s, x: s + x["n"]).alias("in_lang")
    counts = _near(terms.select("lang", "term", in_lang, F.inline("places")), groups, ["lang", "source"]).select(
        "lang", "term", "source", "p0", share(F.col("n"), F.col("total")).alias("p"),
        share(F.col("in_lang"), F.col("lang_total")).alias("q"))
    counts = write_and_read(counts, work_path(spark, "audit_counts"))

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    by_term = (counts.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                             distance(F.col("p"), F.col("q")).alias("value"))
               .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top_terms))

    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    whole = "decimal(38,0)"
    neither = groups.join(other, "lang").filter("source <> item").select("lang", "source", "item", F.coalesce(
        F.col("kept").cast(whole) * distance(F.col("p0"), F.col("q0")).cast(whole), F.lit(0).cast(whole)).alias("part"))

    levels = counts.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("terms"))
    met = _near(levels, other, "lang").filter("source <> item")
    here = distance(F.col("p"), F.col("q0")) - distance(F.col("p0"), F.col("q0"))
    there = distance(F.col("q0"), F.col("p")) - distance(F.col("q0"), F.col("p0"))
    times = F.col("terms").cast("decimal(18,0)")
    both = F.explode(F.array(
        F.struct("source", "item", (times * here.cast("decimal(19,0)")).cast(whole).alias("part")),
        F.struct(F.col("item").alias("source"), F.col("source").alias("item"),
                 (times * there.cast("decimal(19,0)")).cast(whole).alias("part"))))
    one = met.select("lang", both.alias("x")).select("lang", "x.*")

    vectors = counts.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "p0")).alias("places"))
    shared = vectors.filter(F.size("places") > 1).select("lang", "places").mapInArrow(
        _pair_lots, "lang string, source string, item string, part long")
    sums = (neither.unionByName(one).unionByName(shared.withColumn("part", F.col("part").cast(whole)))
            .groupBy("lang", "source", "item").agg(F.sum("part").alias("value")))
    turn, half = F.lit(str(1 << 64)).cast(whole), F.lit(str(1 << 63)).cast(whole)
    by_pair = sums.select("lang", "source", F.lit("pair").alias("part"), "item",
                          (F.pmod(F.col("value") + half, turn) - half).cast("long").alias("value"))
    by_pair = by_pair.withColumn("rank", F.row_number().over(best))
    return by_pair.unionByName(by_term)


def op13_source_audit(spark, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents),
w AS (SELECT i, lang, source, unnest(words) AS term FROM d),
k AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT i) >= 3),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
g AS (
  SELECT d.lang, d.source, coalesce(any_value(v.v), 0) AS v,
         coalesce((SELECT sum(n) FROM c WHERE c.lang = d.lang AND c.source = d.source), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM d) d LEFT JOIN v USING (lang) GROUP BY d.lang, d.source),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         (1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (g.n + g.v))::HUGEINT AS p
  FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
q AS (
  SELECT k.lang, k.term,
         (1 + 1000000000::HUGEINT * ((SELECT sum(n) FROM c WHERE c.lang = k.lang AND c.term = k.term) + 1)
              // ((SELECT sum(n) FROM c WHERE c.lang = k.lang) + v.v))::HUGEINT AS q
  FROM k JOIN v USING (lang)),
t AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p.p - q.q) * (p.p - q.q) // q.q)::BIGINT AS value
  FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q),
s AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT * FROM t)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM r QUALIFY part = 'pair' OR rank <= 200
"""

"""Mixing sources to target weights: Efraimidis-Spirakis sampling with columns and SQL functions only.

Every row gets a random number ``u`` from a hash of its key and seed, and the exponential key ``-ln(u) / w`` with ``w`` its
quality weight: ordering by that key is weighted sampling without replacement. A source with target ``t`` and ``s`` words
is taken ``floor(t / s)`` times whole; what is left is filled with its rows in key order until the budget is nearest.

No source is sorted whole. The key range of a source is cut into buckets of about ``BUCKET_ROWS`` rows whose sums are
prefix-summed; only rows of the bucket in which a budget ends are ordered. That gives one boundary per source, and each
row is judged by comparing it with its source's boundary: no shuffle of documents, whatever share one source has.

Rows with the same source, key, size and ``u`` are taken together, or not at all. Null or empty texts have size 0, and
taking them takes nothing. A null source is a source of its own. Weights must be positive and of one order of magnitude,
null counts as 1. An empty table gives no rows. Other columns are passed through untouched by :func:`repeat_rows`.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newszones.llm.words import n_words
from newszones.sources.storage import work_path, write_and_read

BUCKET_ROWS = 4000
SEED = "mix"


def exponential_key(key: str, weight: Column, seed: str = SEED) -> Column:
    """``-ln(u) / w`` with ``u`` from 52 bits of a hash of ``seed`` and ``key``."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("")))), 1, 13), 16, 10)
    u = (bits.cast("double") + F.lit(0.5)) / F.lit(2.0 ** 52)
    return -F.log(u) / F.coalesce(weight, F.lit(1.0))


def letter_weight(text: str) -> Column:
    """Quality weight of a text: a tenth plus the share of its characters that are letters."""
    n = F.length(F.coalesce(F.col(text), F.lit("")))
    letters = F.length(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[^\p{L}]", ""))
    return F.lit(0.1) + letters.cast("double") / F.greatest(n, F.lit(1))


def targets(sources: DataFrame, total_share: float, cap: float) -> DataFrame:
    """Add ``target`` to ``source, source_size, share_weight``: ``total_share`` of all sizes, dealt by weight, none above
    ``cap`` times its source. Sources that reach their cap give the excess to the others: with sources in the order of
    cap over weight, the level is that of the first source that the rest can pay for."""
    order = Window.orderBy("ratio", "share_weight", "source").rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy("ratio", "share_weight", "source").rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    capped = F.col("source_size") * F.lit(float(cap))
    level = ((F.col("budget") - F.coalesce(F.sum("capped").over(order), F.lit(0.0)))
             / F.sum("share_weight").over(rest))
    return (sources.withColumn("capped", capped).withColumn("ratio", capped / F.col("share_weight"))
            .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(total_share)))
            .withColumn("level", level)
            .withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level")))
                        .over(everything)["level"])
            .withColumn("target", F.coalesce(F.least("capped", F.col("level") * F.col("share_weight")), "capped"))
            .drop("capped", "ratio", "budget", "level"))


def cyclic_weights(sources: DataFrame, weights: list[float]) -> DataFrame:
    """Add ``share_weight``: ``weights`` in turn over the sources by code point, null last."""
    at = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.withColumn("share_weight", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (at % len(weights) + 1).cast("int")))


def sizes(docs: DataFrame, key: str, source: str, size: Column, weight: Column) -> DataFrame:
    """``key, source, size, u_key``: all that planning needs, without texts."""
    return docs.select(F.col(key).alias("key"), F.col(source).alias("source"), size.alias("size"),
                       exponential_key(key, weight).alias("u_key"))


def plan(rows: DataFrame, share_weights, total_share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row per source: ``source, source_size, target, epochs, edge``. ``share_weights`` adds ``share_weight`` to the
    table of sources. ``edge`` is the last ``struct(u_key, key, size)`` that the fractional part takes, null for none."""
    spark = rows.sparkSession
    totals = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("source_rows"), F.avg("u_key").alias("mean_key"))
    sources = targets(share_weights(totals), total_share, cap)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    sources = (sources.withColumn("epochs", whole)
               .withColumn("left", F.col("target") - F.col("epochs") * F.col("source_size")))
    sources = write_and_read(sources, work_path(spark, "mix_sources"))

    n_buckets = F.ceil(F.col("source_rows") / F.lit(BUCKET_ROWS))
    bucket = F.floor((F.lit(1.0) - F.exp(-F.col("u_key") / F.greatest("mean_key", F.lit(1e-12)))) * n_buckets)
    dealt = _with_source(rows, sources.select("source", "source_rows", "mean_key")).withColumn("bucket", bucket)
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = (dealt.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
            .withColumn("before", F.coalesce(F.sum("bucket_size").over(running), F.lit(0))))
    ends = (_with_source(sums, sources.select("source", "left"))
            .filter((F.col("before") <= F.col("left")) & (F.col("before") + F.col("bucket_size") >= F.col("left")))
            .groupBy("source").agg(F.min(F.struct("bucket", "before", "left")).alias("end"))
            .select("source", "end.*"))
    ordered = Window.partitionBy("source").orderBy("u_key", "key", "size")
    near = (_with_source(dealt, ends.withColumnRenamed("bucket", "end_bucket"))
            .filter(F.col("bucket") == F.col("end_bucket"))
            .groupBy("source", "u_key", "key", "size", "before", "left").agg((F.count("*") * F.col("size")).alias("words"))
            .withColumn("upto", F.col("before") + F.sum("words").over(ordered.rowsBetween(Window.unboundedPreceding, 0))))
    inside = F.col("upto") - F.col("words") / 2 <= F.col("left")
    edges = near.groupBy("source").agg(
        F.max(F.when(inside, F.struct("u_key", "key", "size"))).alias("edge"),
        F.min(F.col("u_key")).alias("first"))
    return write_and_read(
        _with_source(sources, edges, "left").select("source", "source_size", "target", "epochs", "edge", "first"),
        work_path(spark, "mix_plan"))


def _with_source(rows: DataFrame, other: DataFrame, how: str = "inner") -> DataFrame:
    other = other.withColumnRenamed("source", "source_")
    return rows.join(other, F.col("source").eqNullSafe(F.col("source_")), how).drop("source_")


def times() -> Column:
    """How often a row with ``key, size, u_key`` and its source's plan is taken."""
    me = F.struct("u_key", "key", "size")
    extra = F.when(F.col("edge").isNotNull(), me <= F.col("edge")).otherwise(F.col("u_key") < F.col("first"))
    return F.col("epochs") + F.coalesce(extra, F.lit(False)).cast("long")


def mix(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """``rows`` of :func:`sizes` with ``source_size, target, times``."""
    return _with_source(rows, planned).withColumn("times", times()).drop("edge", "first", "epochs")


def repeat_rows(docs: DataFrame, planned: DataFrame, key: str, source: str, size: Column, weight: Column) -> DataFrame:
    """``docs`` as the mix takes them: a row taken twice is there twice, a row not taken is gone."""
    columns = [F.col(f"row.`{c}`") for c in docs.columns]
    me = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(key).alias("key"), F.col(source).alias("source"),
                     size.alias("size"), exponential_key(key, weight).alias("u_key"))
    taken = mix(me, planned).filter("times > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("nth")).select(*columns)


#: The mix of the registered query and of the pipeline.
SHARE_WEIGHTS = [3, 1, 2]


def plan_documents(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = write_and_read(sizes(docs, "doc_id", "source", n_words("text"), letter_weight("text")),
                          work_path(docs.sparkSession, "mix_rows"))
    return rows, plan(rows, lambda s: cyclic_weights(s, SHARE_WEIGHTS))


def op2_mix_sources(spark, sf_dir: str) -> DataFrame:
    rows, planned = plan_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mix(rows, planned).select(
        F.col("key").alias("doc_id"), "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"))


def mix_documents(docs: DataFrame) -> DataFrame:
    """The pipeline's stage: documents, repeated as the mix takes them."""
    _, planned = plan_documents(docs)
    return repeat_rows(docs, planned, "doc_id", "source", n_words("text"), letter_weight("text"))


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         (('0x' || md5('mix' || coalesce(doc_id::VARCHAR, ''))[1:13])::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u,
         0.1 + length(regexp_replace(coalesce(text, ''), '[^\p{L}]', '', 'g'))::DOUBLE
               / greatest(length(coalesce(text, '')), 1) AS w
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT]::DOUBLE AS sw
  FROM d GROUP BY source),
r AS (SELECT *, 2.0 * source_size / sw AS ratio FROM s),
l AS (
  SELECT *, ((SELECT sum(source_size) FROM s)::DOUBLE * 1.5 - coalesce(sum(2.0::DOUBLE * source_size) OVER (
              ORDER BY ratio, sw, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(sw) OVER (ORDER BY ratio, sw, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM r),
t AS (
  SELECT source, source_size,
         least(2.0::DOUBLE * source_size, sw * (SELECT arg_min(level, ratio) FROM l WHERE level <= ratio)) AS target
  FROM l),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, -ln(d.u) / d.w AS k,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs, d.source
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) - size / 2.0
            <= target - epochs * source_size AS extra
  FROM p)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       ((epochs + extra::INT) * size)::BIGINT AS taken
FROM q
"""

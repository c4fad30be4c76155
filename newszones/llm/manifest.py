"""Merkle manifest of a dataset: one leaf per row, a tree per language, a tree over their roots, and a climb by recursive SQL.

A leaf is the SHA-256 of the row's fields, a node that of its children's digests as hex text; the last node of a level that
is alone is hashed by itself.

1. *Places.* Leaves are range-partitioned by language, key and digest; a row's place is its number in the partition plus
   what the partitions before hold of its language. No language is sorted in one task.
2. *Levels.* ``2^BITS`` consecutive nodes make a block, a task builds the ``BITS`` levels above them, and the block's top is
   a node of the next step; four steps are enough for 10^12 rows. Every node is stored with the link to the block's top
   (its parent row) and the siblings on the way. A tree ends in its only node, which is linked to the tree over the
   languages.
3. *Climb.* A recursive query follows the links from each leaf, appends the siblings to the leaf's proof and folds the
   leaf's digest, tampered or not, with them. A parent is stored once for each ``SALT_ROWS`` leaves below it, and a leaf
   looks up the copy of its number, so that the node which a third of all rows end in is no hot key.

Nulls are hashed as ``-``; a row without key comes first in its language and is not tampered with. Rows with one key are
ordered by digest; equal rows are leaves of their own. An empty text is hashed as such, texts of any length whole. An empty
table gives no rows. Other columns are not hashed.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newszones.sources.storage import work_path, write_and_read

#: Levels that a block builds, and rows that share one copy of a parent.
BITS = 10
SALT_ROWS = 512
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_IN_PARTITION = (1 << 33) - 1


def field(value: Column) -> Column:
    """A field as it is hashed: ``-`` for null, else its length in UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def _hash(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaves(docs: DataFrame) -> DataFrame:
    """``lang, doc_id, digest, tampered``: where 7 divides the key's CRC-32, tampering has added 1 to ``n_chars``."""
    own = [field(F.col(c)) for c in FIELDS]
    changed = [field(F.col(c).cast("decimal(38,0)") + F.lit(1)) if c == "n_chars" else x for c, x in zip(FIELDS, own)]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return docs.select("lang", "doc_id", _hash(F.concat(*own)).alias("digest"),
                       F.when(chosen & F.col("n_chars").isNotNull(), _hash(F.concat(*changed))).alias("tampered"))


def placed(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Add ``pos``, the row's number from 0 in its group, and ``size``, the group's rows; written on the way."""
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order]]
    dealt = rows.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id())
    dealt = write_and_read(dealt, work_path(spark, "manifest_order"))
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit(_IN_PARTITION))
    dealt = dealt.withColumn("part", part).withColumn("place", place).drop("at")
    runs = dealt.groupBy("part", F.col(group).alias("group_")).agg(F.min("place").alias("first"), F.count("*").alias("run"))
    of_group = Window.partitionBy("group_")
    before = of_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("part", "group_", (F.coalesce(F.sum("run").over(before), F.lit(0)) - F.col("first")).alias("shift"),
                       F.sum("run").over(of_group).alias("size"))
    return (dealt.join(runs.withColumnRenamed("part", "part_"),
                       (F.col("part") == F.col("part_")) & F.col(group).eqNullSafe(F.col("group_")))
            .withColumn("pos", F.col("place") + F.col("shift")).drop("part", "part_", "place", "shift", "group_"))


def _levels(size: Column) -> Column:
    """Levels above ``size`` nodes, as far as one block goes."""
    return F.least(F.lit(BITS), F.length(F.regexp_replace(F.bin(size - 1), "^0+", ""))).cast("int")


def _blocks(nodes: DataFrame) -> DataFrame:
    """Blocks of ``g, size, pos, digest, leaves, load``: the top's digest, and each member with its siblings."""
    member = F.struct("pos", F.lower(F.hex("digest")).alias("digest"), "leaves", "load")
    rows = nodes.groupBy("g", "size", F.shiftright("pos", BITS).alias("block")).agg(
        F.sort_array(F.collect_list(member)).alias("members"), F.sum("leaves").alias("below"))
    rows = rows.withColumn("levels", _levels(F.col("size"))).withColumn("l0", F.col("members.digest"))
    for h in range(BITS):
        low = f"l{h}"
        pairs = F.transform(F.sequence(F.lit(0), F.shiftright(F.size(low) - 1, 1)), lambda i: F.sha2(F.concat(
            F.get(F.col(low), i * 2), F.coalesce(F.get(F.col(low), i * 2 + 1), F.lit(""))).cast("binary"), 256))
        rows = rows.withColumn(f"l{h + 1}", F.when(F.col("levels") > h, pairs).otherwise(F.col(low)))
    return rows.select("g", "size", "block", "below", "levels", F.unhex(F.col(f"l{BITS}")[0]).alias("top"), "members",
                       F.array(*[F.col(f"l{h}") for h in range(BITS)]).alias("rungs"))


def _members(blocks: DataFrame) -> DataFrame:
    """One row per member: ``pos, digest, leaves, load, low, siblings``, null for a sibling that is not there."""
    def one(x, i):
        siblings = F.transform(F.sequence(F.lit(1), F.col("levels")), lambda h: F.unhex(F.get(
            F.get(F.col("rungs"), h - 1), F.call_function("shiftright", i, h - 1).bitwiseXOR(F.lit(1)))))
        return F.struct(x["pos"].alias("pos"), F.unhex(x["digest"]).alias("digest"), x["leaves"].alias("leaves"),
                        x["load"].alias("load"), i.alias("low"), siblings.alias("siblings"))

    return blocks.select("g", "block", "below", F.explode(F.transform("members", one)).alias("x")).select(
        "g", "block", "below", "x.*")


def _copies(leaves_below) -> Column:
    return F.ceil(leaves_below / F.lit(SALT_ROWS)).cast("long")


def build(spark, rows: DataFrame, tree: int) -> tuple[DataFrame, DataFrame]:
    """All nodes of the trees over ``g, size, pos, digest, leaves, load``, and ``g, top, leaves`` of each tree.

    Nodes: ``tree, g, step, pos, digest, load, leaves, low, siblings`` and the parent's ``up_step, up_pos, up_copies``; the top
    of a tree has no parent.
    """
    link = [F.lit(None).cast("int").alias("up_step"), F.lit(None).cast("long").alias("up_pos"),
            F.lit(None).cast("long").alias("up_copies")]
    step, nodes, tops = 0, None, None
    while True:
        alone = rows.filter("size = 1")
        top = alone.select("g", F.col("digest").alias("top"), "leaves")
        end = alone.select(F.lit(tree).alias("tree"), "g", F.lit(step).alias("step"), "pos", "digest", "load", "leaves",
                           F.lit(0).alias("low"), F.array().cast("array<binary>").alias("siblings"), *link)
        tops = top if tops is None else tops.unionByName(top)
        nodes = end if nodes is None else nodes.unionByName(end)
        if rows.filter("size > 1").isEmpty():
            return nodes, tops
        blocks = write_and_read(_blocks(rows.filter("size > 1")), work_path(spark, "manifest_blocks"))
        nodes = nodes.unionByName(_members(blocks).select(
            F.lit(tree).alias("tree"), "g", F.lit(step).alias("step"), "pos", "digest", "load", "leaves", "low", "siblings",
            F.lit(step + 1).alias("up_step"), F.col("block").alias("up_pos"), _copies(F.col("below")).alias("up_copies")))
        rows = blocks.select(
            "g", F.ceil(F.col("size") / F.lit(float(1 << BITS))).cast("long").alias("size"), F.col("block").alias("pos"),
            F.col("top").alias("digest"), F.col("below").alias("leaves"),
            F.lit(None).cast(dict(rows.dtypes)["load"]).alias("load"))
        step += 1


#: A digest with its siblings, bottom up; bit by bit ``low`` says on which side it stands.
_FOLD = """aggregate({siblings}, named_struct('h', {start}, 'b', CAST({low} AS BIGINT)), (a, s) -> named_struct(
  'h', CASE WHEN s IS NULL THEN sha2(a.h, 256) WHEN a.b % 2 = 0 THEN sha2(concat(a.h, lower(hex(s))), 256)
            ELSE sha2(concat(lower(hex(s)), a.h), 256) END, 'b', a.b div 2), a -> a.h)"""
_APPEND = "aggregate({siblings}, {start}, (a, s) -> concat(a, coalesce(s, X'')))"
_CLIMB = f"""
WITH RECURSIVE climb(place, doc_id, leaf, folded, proof, subroot, tree, g, step, pos, copies) AS (
  SELECT pos, load.doc_id, digest, {_FOLD.format(siblings="siblings", low="low",
                                                 start="lower(hex(coalesce(load.tampered, digest)))")},
         {_APPEND.format(siblings="siblings", start="X''")}, CAST(NULL AS BINARY),
         up_tree, up_g, up_step, up_pos, up_copies
  FROM {{leaves}}
  UNION ALL
  SELECT c.place, c.doc_id, c.leaf, {_FOLD.format(siblings="n.siblings", low="n.low", start="c.folded")},
         {_APPEND.format(siblings="n.siblings", start="c.proof")},
         CASE WHEN n.tree = 1 AND n.step = 0 THEN n.digest ELSE c.subroot END,
         n.up_tree, n.up_g, n.up_step, n.up_pos, n.up_copies
  FROM climb c JOIN {{nodes}} n
    ON n.tree = c.tree AND n.g = c.g AND n.step = c.step AND n.pos = c.pos AND n.copy = pmod(c.place, c.copies))
SELECT doc_id, lower(hex(leaf)) AS leaf, lower(hex(subroot)) AS subroot, folded AS folded_root, proof
FROM climb WHERE tree IS NULL
"""


def manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row; written to the shared folder."""
    spark = docs.sparkSession
    rows = placed(write_and_read(leaves(docs), work_path(spark, "manifest_leaves")), "lang", ["doc_id", "digest"])
    langs = placed(rows.select("lang").distinct().withColumn("all", F.lit(0)), "all", ["lang"])
    langs = write_and_read(langs.select(F.col("lang").alias("lang_"), F.col("pos").alias("g"), F.col("size").alias("langs")),
                           work_path(spark, "manifest_langs"))
    rows = rows.join(langs, F.col("lang").eqNullSafe(F.col("lang_"))).select(
        "g", "size", "pos", "digest", F.lit(1).cast("long").alias("leaves"), F.struct("doc_id", "tampered").alias("load"))
    rows = write_and_read(rows, work_path(spark, "manifest_rows"))
    below, subroots = build(spark, rows, 0)
    subroots = write_and_read(subroots, work_path(spark, "manifest_subroots"))
    over = subroots.join(langs.select("g", "langs"), "g").select(
        F.lit(0).cast("long").alias("g"), F.col("langs").alias("size"), F.col("g").alias("pos"),
        F.col("top").alias("digest"), "leaves", F.lit(None).cast(dict(rows.dtypes)["load"]).alias("load"))
    above, roots = build(spark, over, 1)
    root = roots.first()
    # The top of a language's tree is linked to its leaf in the tree over the languages.
    top = F.col("up_step").isNull() & (F.col("tree") == 0)
    nodes = below.unionByName(above).select(
        "tree", "g", "step", "pos", "digest", "load", "leaves", "low", "siblings",
        F.when(top, F.lit(1)).when(F.col("up_step").isNotNull(), F.col("tree")).alias("up_tree"),
        F.when(top, F.lit(0).cast("long")).otherwise(F.col("g")).alias("up_g"),
        F.when(top, F.lit(0)).otherwise(F.col("up_step")).alias("up_step"),
        F.when(top, F.col("g")).otherwise(F.col("up_pos")).alias("up_pos"),
        F.when(top, _copies(F.col("leaves"))).otherwise(F.col("up_copies")).alias("up_copies"))
    is_leaf = (F.col("tree") == 0) & (F.col("step") == 0)
    stored = write_and_read(nodes.filter(~is_leaf).withColumn("copy", F.explode(
        F.sequence(F.lit(0).cast("long"), _copies(F.col("leaves")) - 1))), work_path(spark, "manifest_nodes"))
    climbed = _unlimited(spark, _CLIMB, {"leaves": nodes.filter(is_leaf), "nodes": stored})
    whole = F.lit(None if root is None else root["top"].hex()).cast("string")
    return climbed.select(
        "doc_id", "leaf", "subroot", whole.alias("root"), F.sha2(_hex(F.col("proof")).cast("binary"), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == whole).alias("verified"))


def _unlimited(spark, query: str, tables: dict[str, DataFrame]) -> DataFrame:
    """The written result of a recursive query, whose number of rows Spark would limit to a million."""
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        return write_and_read(spark.sql(query, **tables), work_path(spark, "manifest_climb"))
    finally:
        spark.conf.set(name, before)


def op11_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    return manifest(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP11_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, b:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i::BIGINT)) AS t),
d AS (
  SELECT doc_id, lang, CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END AS f1,
         CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END AS f2,
         CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS f3,
         CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END AS f4,
         CASE WHEN n_chars IS NULL THEN '-' ELSE strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1) END AS f4t,
         CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS f5,
         xor(4294967295, list_reduce(list_transform(split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT), lambda c, b:
             xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT)) % 7 = 0 AS chosen
  FROM documents, crc),
leaf AS (
  SELECT doc_id, lang, sha256(f1 || f2 || f3 || f4 || f5) AS leaf,
         CASE WHEN chosen THEN sha256(f1 || f2 || f3 || f4t || f5) ELSE sha256(f1 || f2 || f3 || f4 || f5) END AS start
  FROM d),
num AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g
  FROM leaf),
low AS (
  SELECT g, 0 AS h, pos, leaf AS digest, count(*) OVER (PARTITION BY g) AS n FROM num
  UNION ALL
  SELECT g, h + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2 FROM low WHERE n > 1
  GROUP BY g, h, pos // 2, n),
sub AS (SELECT g, h, digest FROM low WHERE n = 1),
top AS (
  SELECT 0 AS h, g AS pos, digest, count(*) OVER () AS n FROM sub
  UNION ALL
  SELECT h + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2 FROM top WHERE n > 1
  GROUP BY h, pos // 2, n),
climb AS (
  SELECT num.g, num.pos AS place, doc_id, leaf, start, 0 AS h, 0 AS part, num.pos, start AS folded, '' AS proof FROM num
  UNION ALL
  SELECT c.g, c.place, c.doc_id, c.leaf, c.start,
         CASE WHEN done THEN 0 ELSE c.h + 1 END, CASE WHEN done THEN 1 ELSE c.part END,
         CASE WHEN done THEN c.g ELSE c.pos // 2 END,
         CASE WHEN done THEN c.folded WHEN s IS NULL THEN sha256(c.folded) WHEN c.pos % 2 = 0 THEN sha256(c.folded || s)
              ELSE sha256(s || c.folded) END,
         c.proof || CASE WHEN done THEN '' ELSE coalesce(s, '') END
  FROM (
    SELECT c.*, CASE WHEN c.part = 0 THEN a.n = 1 ELSE false END AS done,
           CASE WHEN c.part = 0 THEN b.digest ELSE y.digest END AS s,
           CASE WHEN c.part = 0 THEN true ELSE x.n > 1 END AS goes_on
    FROM climb c
    LEFT JOIN low a ON c.part = 0 AND a.g = c.g AND a.h = c.h AND a.pos = c.pos
    LEFT JOIN low b ON c.part = 0 AND b.g = c.g AND b.h = c.h AND b.pos = xor(c.pos, 1)
    LEFT JOIN top x ON c.part = 1 AND x.h = c.h AND x.pos = c.pos
    LEFT JOIN top y ON c.part = 1 AND y.h = c.h AND y.pos = xor(c.pos, 1)) c
  WHERE goes_on)
SELECT c.doc_id, c.leaf, sub.digest AS subroot, root.digest AS root, sha256(c.proof) AS proof_sha256,
       c.folded AS folded_root, c.folded = root.digest AS verified
FROM climb c JOIN sub ON sub.g = c.g JOIN top root ON root.n = 1 AND root.h = c.h
WHERE c.part = 1
"""

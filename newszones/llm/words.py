"""Words as the operators of this subpackage cut them, on UTF-8 bytes and on columns."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space: U+0020 and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def bytes_of(name: str) -> Column:
    """A text column as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")


def n_words(name: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(name), F.lit(WORD)), F.lit(0)).cast("long")


def fresh_name(docs: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column is called so, in whatever case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def through_python(docs: DataFrame, text: str) -> tuple[DataFrame, list[Column], int]:
    """``docs`` for a function on Arrow batches: columns ``c0, c1, ...``, the text among them as bytes (null stays null); the
    columns that undo it; and the place of the text."""
    at = [c.lower() for c in docs.columns].index(text.lower())
    kind = docs.schema[at].dataType
    columns = [F.col(f"`{c}`") for c in docs.columns]
    inside = [(c.cast("string").cast("binary") if i == at else c).alias(f"c{i}") for i, c in enumerate(columns)]
    outside = [(F.col(f"c{i}").cast("string").cast(kind) if i == at else F.col(f"c{i}")).alias(c)
               for i, c in enumerate(docs.columns)]
    return docs.select(*inside), outside, at

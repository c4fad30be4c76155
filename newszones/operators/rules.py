"""Extraction rules as a table: which selectors find a source's articles and their fields."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newszones import fixed_values as fixed
from newszones import schemas

# Rules travel in the function that uses them. A table beyond this is no configuration and is refused, never cut.
MAX_RULE_BYTES = 64 << 20
NEXT_PAGE = "next_page"


def default_rules(spark: SparkSession) -> DataFrame:
    """The rules for the three known sources. A rule without a row selector looks at the whole page."""
    rows = []
    for source, spec in fixed.SELECTORS.items():
        for row_order, row_selector in enumerate(spec["rows"]):
            for field, (selectors, mode, default) in spec["fields"].items():
                for fallback_order, selector in enumerate(selectors):
                    rows.append((source, row_selector, row_order, field, selector, fallback_order, mode, default))
        if "next_page" in spec:
            rows.append((source, None, 0, NEXT_PAGE, spec["next_page"], 0, "first", None))
    return spark.createDataFrame(rows, schemas.RULES)


def collect_rules(rules: DataFrame | list, max_bytes: int = MAX_RULE_BYTES) -> list:
    """The rules as rows, after a check of their size; rules that are collected already stay as they are."""
    if isinstance(rules, list):
        return rules
    size = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in rules.columns), F.lit(0))
    measured = rules.agg(F.sum(size)).first()[0] or 0
    if measured > max_bytes:
        raise ValueError(f"{measured} bytes of extraction rules; at most {max_bytes} are meant")
    return rules.collect()

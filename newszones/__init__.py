"""News pages to reports on Spark: extraction, three table zones, report queries."""

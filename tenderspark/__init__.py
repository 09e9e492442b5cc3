"""Tender price research on Spark: DataFrame operators for matching, ranking, ingest and comparison."""

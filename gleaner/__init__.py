"""Article curation on Spark: DataFrame operators for feeds, pages, bodies, rules and digests."""

__version__ = "0.1.0"

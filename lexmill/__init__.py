"""lexmill: a Spark-native engine for structuring, auditing and deduplicating large collections of official texts."""

"""Spark-native entity analytics: search, match, repair, merge and monitor large relational extracts."""

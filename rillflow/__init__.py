"""A Spark-native engine for document corpora: plan, convert, link, track and report."""

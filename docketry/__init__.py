"""Spark-native warehouse for captured court-docket pages."""

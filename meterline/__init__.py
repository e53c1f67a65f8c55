"""Spark-native trip and event analytics: every function takes and returns DataFrames."""

"""Spark-native discovery-evidence and inventory analytics: functions over DataFrames."""

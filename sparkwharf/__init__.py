"""sparkwharf: Spark-native analytics for time-stamped operational and geospatial feeds."""

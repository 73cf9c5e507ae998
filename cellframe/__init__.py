"""A PySpark-native analytics engine for gridded geospatial data."""

"""tripmart: a PySpark-native analytics engine for ride-hailing trip records."""

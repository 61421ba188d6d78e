"""A PySpark-native engine for river-flood preparation tables, grids and networks."""

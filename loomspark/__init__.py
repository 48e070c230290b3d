"""A PySpark-native analytics engine for agent and model traces."""

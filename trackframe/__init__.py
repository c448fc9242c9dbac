"""PySpark-native engine for ordered, episode-structured time-series data."""

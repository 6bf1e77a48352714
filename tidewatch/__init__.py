"""Tidewatch: a PySpark-native analytics engine for remote-sensing incident data."""

"""A PySpark engine for network-flow analytics."""

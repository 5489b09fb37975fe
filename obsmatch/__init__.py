"""obsmatch: nearest-station and nearest-observation matching of point events, on Spark."""

__version__ = "0.1.0"

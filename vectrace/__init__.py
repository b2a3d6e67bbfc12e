"""vectrace: PySpark-native analytics for motion-vector tables and frame-level time series."""

__version__ = "0.1.0"

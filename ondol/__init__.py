"""ondol: a PySpark-native analytics and data-preparation engine for classified-listing boards."""

__version__ = "0.1.0"

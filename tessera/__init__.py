"""tessera: the reference's data-processing capabilities as composable PySpark operators."""

__version__ = "0.1.0"

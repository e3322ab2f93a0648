"""hedonic: Spark DataFrame operators for temporally honest price modelling."""

__version__ = "0.1.0"

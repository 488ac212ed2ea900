"""quayside: maritime and seismic risk data processing on Spark DataFrames."""

__version__ = "0.1.0"

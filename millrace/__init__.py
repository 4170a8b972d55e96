"""millrace: a knowledge-unit data engine built from PySpark DataFrames."""

__version__ = "0.1.0"

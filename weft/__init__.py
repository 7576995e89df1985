"""weft: registry linkage, data quality and star-schema building as Spark plans."""

__version__ = "0.1.0"

"""Comment-corpus curation and labelling tables on Spark DataFrames."""

__version__ = "0.1.0"

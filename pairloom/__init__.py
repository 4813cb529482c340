"""pairloom: preparing and judging NL-to-SQL training pairs on Spark DataFrames."""

__version__ = "0.1.0"

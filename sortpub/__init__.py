"""sortpub: ordered publishing of record tables on Spark DataFrames.

Parse delimited lines into records (with a reject table), profile the sort key,
put the table into a total order, give each record its global position without
funnelling rows through one task, and publish one ordered output per key.
"""

__version__ = "0.1.0"

"""Training-data operators: deduplication, tokenising, filtering, mixing, sharding.

Every operator takes a DataFrame, reads only the columns it names and returns a
DataFrame. Nothing outside this subpackage (and the pipeline script) imports it.
"""

"""Incremental forms of the batch jobs (Structured Streaming).

The studied jobs are batch only; the one job whose input naturally grows by
appends (reviews -> word frequencies) is offered here as a stream over the same
operators, so new files update the counts without recounting old ones.
"""

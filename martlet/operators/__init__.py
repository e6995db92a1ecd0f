"""DataFrame-in, DataFrame-out operators of the data-mart jobs."""

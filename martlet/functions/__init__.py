"""Column-expression helpers: tolerant casts, missing-value predicates,
stop words, and the distributed exact quantile selection."""

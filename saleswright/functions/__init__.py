"""Column-level building blocks: exact arithmetic, quantiles, dates."""

"""Column-level building blocks: calendar arithmetic, hashes, paths, quantiles, metrics."""

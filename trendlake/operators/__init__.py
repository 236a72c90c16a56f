"""trendlake.operators."""

"""trendlake.sources."""

"""martwell.sources."""

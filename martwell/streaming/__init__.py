"""martwell.streaming."""

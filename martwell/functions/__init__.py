"""martwell.functions."""

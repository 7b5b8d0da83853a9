"""martwell.operators."""

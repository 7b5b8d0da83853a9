"""martwell.plans."""

"""martwell: a retail sales warehouse expressed as Spark DataFrame jobs.

Load flat order files, normalise them into dimension and fact tables, check
keys and values, serve reports, apply corrections with an audit trail (batch
and streaming) and snapshot / restore the whole warehouse.  Every operator is a
function from DataFrames to DataFrames, so Catalyst plans the work and the
cluster runs it.
"""

from martwell.session import build_session, scratch_root

__all__ = ["build_session", "scratch_root"]

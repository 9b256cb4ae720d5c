"""packetflow: packet and event streams on Spark, from intake to read model.

Every operator is a function from DataFrames to a DataFrame, so the same code serves batch jobs
and Structured Streaming ``foreachBatch`` sinks.
"""

from packetflow.session import build_session, prepare, work_dir

__all__ = ["build_session", "prepare", "work_dir"]

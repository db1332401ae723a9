"""sparkmine: graph, matrix, quantile, text-similarity and CUR operators on Spark DataFrames.

Every operator takes and returns DataFrames and is expressed with Spark's own
joins, aggregates, windows and ML estimators, so Catalyst/AQE plan the work.
"""

from sparkmine.session import ensure_checkpoint_dir, get_session, materialize

__all__ = ["get_session", "ensure_checkpoint_dir", "materialize"]

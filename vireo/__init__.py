"""vireo: a Spark-native maintenance star-schema warehouse.

Raw text tables are typed and deduplicated, a type-2 history is built from a
change log in one Spark job, every event is resolved to the dimension version
valid on its date, facts carry unknown members instead of null keys, data
quality rules run in one pass per table, and the business questions are plain
DataFrame plans.
"""

from vireo.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]

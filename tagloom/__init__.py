"""tagloom: tag and token analytics on Spark.

Token counting and top-K per batch, micro-batch and event-time window;
weighted, labelled graphs built, merged and analysed with DataFrames;
and the text, JSON and GEXF formats around them.
"""

from tagloom.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]

"""edgewise: link-prediction analytics on Spark DataFrames.

Directed graphs are plain DataFrames ``edges(src BIGINT, dst BIGINT)``;
candidate vertex pairs are ``pairs(u BIGINT, v BIGINT, label STRING)``.
Every operator takes DataFrames and returns a DataFrame built from
built-in Spark SQL expressions, so Catalyst plans the whole job.
"""

from edgewise.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]

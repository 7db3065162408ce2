"""qamill: question/answer corpus preparation, versioning and profiling on Spark.

Every operator takes and returns a DataFrame (or a Column) and is built from
public DataFrame / SQL functions, so Catalyst plans and distributes the work.
"""

from qamill.session import checkpoint_dir, local_session, scratch_dir

__all__ = ["checkpoint_dir", "local_session", "scratch_dir"]

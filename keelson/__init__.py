"""keelson: feature tables, training sets and model lineage as Spark jobs.

Every row-level step is DataFrame code that runs on executors. The driver
only ever sees schemas, a handful of fitted statistics (one row per fit) and
metadata.
"""

from keelson.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]

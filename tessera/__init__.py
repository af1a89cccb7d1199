"""tessera: text, web-log, entity-resolution and recommendation analytics as
Spark DataFrame jobs.

Every public function takes DataFrames (or Columns) and returns DataFrames
(or Columns); nothing is collected to the driver.
"""

from tessera.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]

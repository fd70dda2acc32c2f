"""quarry: batch and streaming text/table analytics expressed as Spark DataFrame plans.

Every public function takes DataFrames (or a SparkSession plus paths) and returns a
DataFrame. Nothing is collected to the driver; the physical strategy is left to
Catalyst and adaptive query execution.
"""

from quarry.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]

"""arquivo: catalog analytics for a public health-microdata file archive, on Spark.

Every operator is a DataFrame -> DataFrame (or -> Column) transformation built
from Catalyst built-ins. The registry of datasets is a fixed, small table that
is broadcast; listings and store inventories are ordinary distributed tables.
"""

from arquivo.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]

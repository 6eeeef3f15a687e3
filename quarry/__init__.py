"""quarry: DataFrame operators for counting, comparing and grouping events.

Sub-packages
------------
sources    readers, sinks and the fixtures derived from the driver tables
functions  column expressions (built-in Spark functions only)
operators  the data-mining, clustering and classification operators
plans      the registered queries and their DuckDB oracles
streaming  the token counts over a file stream
"""

from quarry.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]

"""Device-telemetry warehouse built on Spark DataFrames.

Subpackages
-----------
functions   column functions: time keys, truncating averages, text folding
operators   DataFrame -> DataFrame steps: sampling, upserts, versioning, facts
sources     stored tables, and adapters that shape given tables into ours
plans       whole reports and jobs composed from the operators
streaming   the same sample and fact steps on streaming DataFrames
queries     the registered queries and the SQL they are checked against
"""

from wattlake.session import build_session

__all__ = ["build_session"]

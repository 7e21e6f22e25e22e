"""cairn: table, change-feed and enrichment operators written as Spark jobs.

Every public operator is a function from DataFrame(s) to a DataFrame (or a
writer that runs a Spark job). Nothing here re-implements a planner or an
executor: the plans are declared with the DataFrame / SQL API and Catalyst,
AQE and Tungsten choose the physical strategy.
"""

from cairn.session import checkpoint_dir, get_spark, read_table

__all__ = ["checkpoint_dir", "get_spark", "read_table"]

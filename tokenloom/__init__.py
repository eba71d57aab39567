"""tokenloom: corpus-to-training-data jobs as Spark DataFrame / SQL plans.

Every public operator is a ``DataFrame -> DataFrame`` function (usable with
``df.transform``) or a ``Column`` expression.  Randomness is a function of row
keys and a seed (see :mod:`tokenloom.functions.keyed`), and order is always an
explicit column, so results do not depend on partitioning, retries or the
number of executors.

The library never creates a SparkSession itself; :mod:`tokenloom.session`
only helps tests and the bench build a local one.
"""

__all__ = ["functions", "sources", "operators", "plans", "streaming"]

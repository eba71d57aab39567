"""Registered queries (one per inventory operator) and their SQL twins.

Importing this package registers everything in
:data:`tokenloom.plans.registry.QUERIES` / :data:`~tokenloom.plans.registry.ORACLE`.
"""

from tokenloom.plans import flagship  # noqa: F401
from tokenloom.plans import text_plans  # noqa: F401
from tokenloom.plans import token_plans  # noqa: F401
from tokenloom.plans import score_plans  # noqa: F401
from tokenloom.plans import sft_plans  # noqa: F401
from tokenloom.plans import metric_plans  # noqa: F401
from tokenloom.plans import packaged_plans  # noqa: F401
from tokenloom.plans import io_plans  # noqa: F401

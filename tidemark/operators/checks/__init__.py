"""Data-quality checks. Each returns the violating rows; an empty result means the check passes."""

from tidemark.operators.checks.aggregates import *  # noqa: F401,F403
from tidemark.operators.checks.columns import *  # noqa: F401,F403
from tidemark.operators.checks.distribution import *  # noqa: F401,F403
from tidemark.operators.checks.kernels import *  # noqa: F401,F403
from tidemark.operators.checks.records import *  # noqa: F401,F403
from tidemark.operators.checks.shape import *  # noqa: F401,F403
from tidemark.operators.checks.strings import *  # noqa: F401,F403
from tidemark.operators.checks.tables import *  # noqa: F401,F403

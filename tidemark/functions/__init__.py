"""Column → Column functions. None of them reads a clock: "now" is always an ``as_of`` argument."""

from tidemark.functions.dates import *  # noqa: F401,F403
from tidemark.functions.keys import *  # noqa: F401,F403
from tidemark.functions.numbers import *  # noqa: F401,F403
from tidemark.functions.text import *  # noqa: F401,F403
from tidemark.functions.web import *  # noqa: F401,F403

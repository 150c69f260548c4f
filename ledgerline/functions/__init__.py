"""Column expressions: text, casts and nulls, dates, arrays and money."""

from .arrays import *  # noqa: F401,F403
from .casts import *  # noqa: F401,F403
from .dates import *  # noqa: F401,F403
from .text import *  # noqa: F401,F403

"""Column-level helpers (scalar functions of SURVEY §2.8)."""

from sparkretail.functions.scalar import *  # noqa: F401,F403
from sparkretail.functions.scalar import __doc__ as _doc  # noqa: F401

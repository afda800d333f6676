from .columns import *  # noqa: F401,F403
from .aggregates import *  # noqa: F401,F403

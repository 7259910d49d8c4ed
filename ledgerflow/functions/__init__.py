from ledgerflow.functions.scalar import *  # noqa: F401,F403
from ledgerflow.functions.scalar import NA_TOKENS, LOG_LEVELS, LOG_LEVEL_PATTERN  # noqa: F401

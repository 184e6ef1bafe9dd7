"""Every registered query and its SQL."""

from . import captions, chatting, gating, keeping, selecting, working  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401

"""Scalar functions (F1-F14) and row predicates."""

from wayfare.functions.scalar import *  # noqa: F401,F403
from wayfare.functions.predicates import *  # noqa: F401,F403

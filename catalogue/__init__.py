"""Named queries over the given tables, one or more per operator."""

from . import cleaning, learning, profiles, sources, spatial  # noqa: F401
from .base import ORACLES, QUERIES  # noqa: F401

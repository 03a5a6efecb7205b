"""All registered queries."""

from . import air, content, live, portal  # noqa: F401
from .base import ORACLE, QUERIES  # noqa: F401

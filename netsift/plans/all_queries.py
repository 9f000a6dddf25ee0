"""Import every query module so that the registry is complete."""

from . import q_analysis, q_detectors, q_io, q_streaming  # noqa: F401
from .registry import REGISTRY  # noqa: F401

"""Trade-event analytics and anomaly scoring as Spark jobs."""

from tapewright.config import Settings
from tapewright.session import build_session

__all__ = ["Settings", "build_session"]

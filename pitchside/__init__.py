"""pitchside: squad scouting and entity-to-group recommendation on Spark DataFrames."""

from .plans.model import ScoutModel, fit, recommend  # noqa: F401
from .session import local_session  # noqa: F401

"""Listening analytics on Spark: stage, marts, reports, checks and extracts.

Every transformation is DataFrame -> DataFrame built from Spark's own
expressions; only ``listenlab.plans.jobs`` writes or triggers jobs.
"""

from listenlab.settings import DEFAULT, EVENT_TYPES, Settings
from listenlab.session import get_spark, checkpoint_dir

__all__ = ["DEFAULT", "EVENT_TYPES", "Settings", "get_spark", "checkpoint_dir"]

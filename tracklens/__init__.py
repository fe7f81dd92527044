"""tracklens: close-encounter analytics for vessel position reports on Spark.

Every public operator is a plain ``DataFrame -> DataFrame`` transform built
from native Spark expressions, so Catalyst sees the whole plan.
"""

from tracklens.config import EncounterConfig, ScoreWeights

__all__ = ["EncounterConfig", "ScoreWeights"]
__version__ = "0.1.0"

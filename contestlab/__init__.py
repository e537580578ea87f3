"""PySpark-native analytics for two-sided contests."""

from contestlab.columns import CONTEST, ContestColumns

__all__ = ["CONTEST", "ContestColumns"]

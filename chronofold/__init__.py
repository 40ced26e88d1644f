"""Spark-native operators for match timelines, ladders, directories and documents."""

from chronofold.session import get_session

__all__ = ["get_session"]

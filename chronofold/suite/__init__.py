"""Checked queries on the test tables; importing the package registers them all."""

from chronofold.suite import models, people, stores, streams, texts, timelines, tracks  # noqa: F401
from chronofold.suite.base import REGISTRY

__all__ = ["REGISTRY"]

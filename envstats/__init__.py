"""envstats: Spark-native analytics for region x day environmental series."""

from envstats.spec import DEFAULT, Spec  # noqa: F401

__version__ = "0.1.0"

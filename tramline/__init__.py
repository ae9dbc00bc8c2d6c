"""tramline: Spark-native transit analytics.

Bronze ingest, Silver cleaning, dimensions, facts, marts, data-quality
rules, live-window analytics and delay models, all expressed as DataFrame /
Spark SQL / MLlib code whose work runs on executors.
"""

__all__ = ["session", "params"]

"""Spark-native medallion analytics: raw JSON extracts to a quality-checked star schema.

Every transformation is a DataFrame-in, DataFrame-out function over built-in
Spark functions. Nothing here triggers a job except the sinks, the landing
validator and the contract enforcement, which say so.
"""

__version__ = "0.1.0"

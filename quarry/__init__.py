"""quarry: Spark-native data jobs for tables and streams.

Every operator is a plain function over DataFrames built on Spark's public
DataFrame, SQL, Structured Streaming and MLlib APIs. Readers and sinks live in
``quarry.sources``; column expressions in ``quarry.functions``; batch operators
in ``quarry.operators``; SQL forms and end-to-end jobs in ``quarry.plans``;
streaming forms in ``quarry.streaming``.
"""

__all__ = ["session", "sources", "functions", "operators", "plans", "streaming"]

"""Engagement, tone and toxicity analytics for social-media posts on Spark.

Every operator takes DataFrames and returns a lazy DataFrame.  The packages are

* ``functions``  column expressions (coercion, text, labels, p-values)
* ``operators``  relational operators (ranks, quantiles, joins, metrics, ...)
* ``learning``   Spark ML pipelines, tuning, clustering and their evaluation
* ``sources``    readers and writers
* ``streaming``  the same scoring and alerting on Structured Streaming
* ``plans``      whole jobs and the registered queries
"""

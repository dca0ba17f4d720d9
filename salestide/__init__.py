"""salestide: retail sales KPIs as lazy, composable Spark DataFrame operators.

Every operator takes canonical DataFrames (see ``salestide.schemas``) plus
keyword parameters and returns a DataFrame without running anything; only
sinks, the batch job, result readers and stream starters run Spark jobs.
"""

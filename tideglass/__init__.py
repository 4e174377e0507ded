"""tideglass: daily revenue insights from nested web-analytics events, on Spark.

Every public function takes and returns DataFrames or Columns. Only the functions that
write (``sources.lake``, ``sources.insight_store``) and the two jobs in ``plans.jobs``
start Spark actions.
"""

"""opsmart: commerce-operations analytics on PySpark.

Every public function takes DataFrames or Columns and returns the same, so a
whole report stays one lazy logical plan that Catalyst can prune and reorder.
"""

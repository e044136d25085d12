"""Tool-call trajectory analytics and training-data preparation on PySpark."""

"""Feature building, training, evaluation and run records on Spark ML."""

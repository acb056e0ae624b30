"""Clinical-study data preparation as Spark DataFrame operators."""

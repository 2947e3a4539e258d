"""subloom: timed-text and dialogue analytics as composable PySpark DataFrame operators."""

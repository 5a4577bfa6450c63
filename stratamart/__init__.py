"""stratamart: Bronze / Silver / Gold retail analytics as plain Spark DataFrame code."""

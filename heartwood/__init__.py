"""Account-health analytics as Spark DataFrame operators."""

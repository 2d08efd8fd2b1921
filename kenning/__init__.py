"""Agent-log knowledge analytics expressed as Spark DataFrame plans."""

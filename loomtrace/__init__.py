"""loomtrace: agent-experience analytics as Spark DataFrame operators."""

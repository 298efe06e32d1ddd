"""Support-ticket analytics as Spark DataFrame operators."""

"""Per-entity event and interval histories as Spark DataFrame operators."""

"""Time-windowed features, sensor tables, point-in-time lookups and model data on Spark."""

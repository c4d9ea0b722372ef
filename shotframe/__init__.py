"""Event-by-event ("shot") experiment analytics as PySpark DataFrame operators."""

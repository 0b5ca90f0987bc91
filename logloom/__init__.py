"""Behaviour-log analytics and training-data operators on PySpark."""

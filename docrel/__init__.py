"""Nested documents as relational tables, kept in step with a change log, on PySpark."""

"""Composed jobs: the weather star schema and the registered queries."""

"""Pipelines composed from the operators: cleaning runs, dashboard and exploration questions."""

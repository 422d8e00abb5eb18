"""Composed plans (workflow), the registered query catalog, and the
independent DuckDB SQL used to check it."""

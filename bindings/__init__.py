"""Bindings of operators and plans to the driver's tables, each with its oracle SQL."""

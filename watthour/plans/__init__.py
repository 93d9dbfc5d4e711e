"""Whole runs put together from the operators: training data, daily forecast, monitoring."""

"""Feature tables, models and recommendations built from the operators."""

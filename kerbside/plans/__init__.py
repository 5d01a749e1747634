"""Models, metrics, reports and checks."""

"""Evidence analytics on Spark."""

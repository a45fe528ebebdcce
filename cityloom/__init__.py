"""Point-of-interest analytics as DataFrame-to-DataFrame functions on Spark."""

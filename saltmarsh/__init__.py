"""saltmarsh: user-level DataFrame operators for tabular analytics on Spark."""

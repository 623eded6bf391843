"""Message-history analytics on Spark."""

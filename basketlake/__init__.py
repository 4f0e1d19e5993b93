"""Point-of-sale analytics as Spark jobs: register logs in, reconciled tables and reports out."""

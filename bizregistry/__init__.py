"""Company-register curation and analytics as Spark DataFrame jobs."""

"""gavel: public-meeting records as Spark DataFrame jobs."""

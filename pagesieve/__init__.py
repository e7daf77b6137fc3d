"""Web-page text classification as Spark jobs."""

"""Web-capture fingerprinting and adoption analytics as Spark jobs."""

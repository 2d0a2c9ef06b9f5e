"""changeguard: governing changes to tables, as Spark jobs."""

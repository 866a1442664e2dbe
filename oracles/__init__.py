"""Independent SQL statements the Spark queries are checked against."""

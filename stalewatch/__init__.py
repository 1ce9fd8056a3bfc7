"""Technology-obsolescence risk analytics as Spark DataFrame operators."""

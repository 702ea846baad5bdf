"""orestrata: raw retail entities in, tested and governed business marts out, as plain Spark jobs."""

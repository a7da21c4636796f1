"""Column expressions. Everything here stays in the JVM; nothing is a Python UDF."""

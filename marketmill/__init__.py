"""Market and company data analytics as plain Spark DataFrame operators."""

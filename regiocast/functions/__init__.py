"""Column and SQL helpers: dates, exact integer arithmetic, region names."""

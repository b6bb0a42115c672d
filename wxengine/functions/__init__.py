"""Column functions: cleaning, exact arithmetic, calendar and forward windows."""

"""Column helpers: text, calendar and money."""

"""Column expressions: text cleaning, calendar, money."""

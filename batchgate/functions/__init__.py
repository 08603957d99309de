"""Column expressions: text cleaning, typing, composite keys, dates, statistics, growth."""

"""Column helpers: times, money, keys."""

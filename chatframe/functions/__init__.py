"""Column expressions: text classes that follow Unicode rules, cleaning, message features, time notations."""

"""Column expressions: text cleaning, URL rules, small arithmetic."""

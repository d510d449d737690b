"""Column expressions: money, calendar, rules, ratios and distances."""

"""DataFrame operators: walking values, budgets, counters, JSON lines."""

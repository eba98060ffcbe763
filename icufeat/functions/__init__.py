"""Column expressions and the order-statistics building blocks."""

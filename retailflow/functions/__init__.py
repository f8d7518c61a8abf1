"""Column expressions and the small vectorised helpers used inside tasks."""

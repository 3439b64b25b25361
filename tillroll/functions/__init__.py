"""Column expressions; none needs Python in the tasks."""

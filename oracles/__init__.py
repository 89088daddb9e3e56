"""Reference answers in SQL for the registered queries."""

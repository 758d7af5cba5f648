"""Reference results in SQL for the registered queries."""

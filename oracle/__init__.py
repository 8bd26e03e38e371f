"""Reference answers in SQL for the registered queries, for checks only."""

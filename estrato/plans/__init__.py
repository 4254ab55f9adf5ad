"""The literacy indicator lake: its tables, checks and reports, declared with the operators."""

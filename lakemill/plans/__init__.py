"""Business metrics and table-driven jobs composed from the operators."""

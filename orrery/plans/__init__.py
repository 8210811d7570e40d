"""Galaxy models, analytics, checks and reports composed from the operators."""

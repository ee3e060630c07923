"""Jobs: chains of operators that answer one question."""

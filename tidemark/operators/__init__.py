"""Row-level operators: dedupe, type-2 history, nested facts."""

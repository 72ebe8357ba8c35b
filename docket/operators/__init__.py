"""Table operators: counting, screening, encoding, selection, models, evidence."""

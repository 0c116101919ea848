"""Column functions: cleaning, lenient parsing, calendar, masking, spreading."""

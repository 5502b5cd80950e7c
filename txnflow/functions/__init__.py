"""Column expressions: message decoding and encoding, time text, exact totals, seeded picks."""

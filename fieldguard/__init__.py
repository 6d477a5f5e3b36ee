"""fieldguard: fail-closed sanitising of text, records and streams as Spark expressions."""

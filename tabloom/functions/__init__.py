"""Column -> Column expressions; everything stays inside Catalyst."""

"""Column expressions: scalar rules and the name parser."""

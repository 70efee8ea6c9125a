"""Column expressions: text, rules, geometry, contacts, scoring."""

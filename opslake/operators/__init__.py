"""Generic, parameterised operators (rules, keys and lookups are arguments)."""

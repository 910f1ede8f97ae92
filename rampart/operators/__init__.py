"""DataFrame -> DataFrame operators (validate, routing, reshape, constraints, load)."""

"""DataFrame -> DataFrame operators: parse, validate, route, join, roll up, detect."""

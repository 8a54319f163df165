"""DataFrame → DataFrame operators: parse, position, order, partition, profile, verify."""

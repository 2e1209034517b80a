"""DataFrame -> DataFrame operators, grouped by capability."""

"""Training-data operators: dealt operators, one module each, and their registered queries."""

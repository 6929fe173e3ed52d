"""Column builders: rules, scores and text."""

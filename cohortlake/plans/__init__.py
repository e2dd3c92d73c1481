"""Tables, checks and reports composed of operators."""

"""Column expressions: scalar functions and the packed-context parser."""

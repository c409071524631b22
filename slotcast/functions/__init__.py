"""Column functions. Built-in expressions only: they stay inside whole-stage codegen."""

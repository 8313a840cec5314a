"""Column -> Column expressions; all of them stay inside whole-stage codegen."""

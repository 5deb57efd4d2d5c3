"""Column -> Column building blocks; everything here stays in whole-stage codegen."""

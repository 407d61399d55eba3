"""Column -> Column helpers. All of them compile into whole-stage codegen."""

"""Column expressions for cleansing; all evaluate inside whole-stage codegen."""

"""Column expressions shared by the jobs; all of them stay inside whole-stage code generation."""

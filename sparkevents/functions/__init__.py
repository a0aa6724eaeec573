"""Column expressions: every function takes Columns and returns a Column, and runs in the JVM."""

"""Column expressions; every one compiles to built-in JVM expressions."""

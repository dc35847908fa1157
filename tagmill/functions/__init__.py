"""Column functions. All but three are built-in expressions that stay in the JVM."""

"""Column-in, Column-out building blocks; everything here stays in JVM codegen."""

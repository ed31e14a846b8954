"""Column-to-column functions. All of them are built from JVM-side expressions."""

"""Column functions: columns in, columns out, inside the JVM but for very long word lists."""

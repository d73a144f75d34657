"""Column-level helpers: ``Column -> Column``, all inside JVM code generation."""

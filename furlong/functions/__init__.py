"""Column expressions: ``Column -> Column``, all evaluated in the JVM."""

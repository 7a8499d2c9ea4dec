"""Column -> Column expressions. Everything here runs in the JVM and adds no shuffle."""

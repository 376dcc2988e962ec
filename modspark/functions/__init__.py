"""Column functions: everything here stays inside the JVM and needs no shuffle."""

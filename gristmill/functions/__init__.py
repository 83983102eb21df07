"""Column-level helpers; everything here stays inside the JVM."""

"""Column functions: text in, text or arrays out, evaluated inside the JVM."""

"""Column expressions; everything but the HTML parser stays inside the JVM."""

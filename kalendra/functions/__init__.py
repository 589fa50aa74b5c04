"""Column expressions; nothing here starts a job or leaves the JVM."""

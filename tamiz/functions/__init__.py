"""Pure Column expressions and narrow DataFrame -> DataFrame steps, all JVM-side."""

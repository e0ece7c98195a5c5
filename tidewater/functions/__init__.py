"""Column-level functions (JVM built-ins, one Arrow UDF for NFKC)."""

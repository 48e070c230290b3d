"""Scalar expressions; all run inside the JVM unless their module says otherwise."""

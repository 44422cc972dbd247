"""Scalar functions: builders of Column expressions that stay inside the JVM."""

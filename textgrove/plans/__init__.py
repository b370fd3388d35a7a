"""End-to-end workflows composed of the operators."""

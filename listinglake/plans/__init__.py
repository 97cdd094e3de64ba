"""User-level jobs composed from sources and operators."""

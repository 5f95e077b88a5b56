"""The jobs a user runs by name, composed from sources and operators."""

"""The jobs, composed from sources and operators."""

"""Multi-step runs composed from the operators."""

"""The analytics users call, composed from the operators."""

"""Feature plans composed from the operators."""

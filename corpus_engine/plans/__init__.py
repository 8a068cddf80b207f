"""Study jobs built from the operators."""

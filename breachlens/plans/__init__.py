"""The stages built from the operators: cleaning, features, analytics, profile, whole run."""

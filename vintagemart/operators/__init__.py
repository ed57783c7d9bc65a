"""DataFrame to DataFrame operators: cleaning, labels, features, checks, profiles."""

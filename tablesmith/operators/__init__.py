"""DataFrame operators: profile, relational, grouping, imputation, encoding, scoring."""

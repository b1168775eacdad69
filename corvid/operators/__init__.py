"""Table operators: readability, dense regression, sparse vectors, logistic
regression, matrix factorisation and feature preparation."""

"""corvid — DataFrame-native learning analytics on Spark.

Four job families over tables: readability scoring of text collections,
dense least squares (ridge by gradient descent, L1-ball by Frank-Wolfe),
sparse logistic regression with a distributed coefficient table, and
latent-factor models of ratings with k-fold cross-validation.
"""

__version__ = "0.1.0"

"""Hyper-parameter grids.

FIXED VALUES: the studied system's search spaces for the forest and one of its two for boosted trees, mapped to Spark ML names
(n_estimators -> numTrees / maxIter, max_depth -> maxDepth (None -> 30),
max_features -> featureSubsetStrategy, learning_rate -> stepSize,
subsample -> subsamplingRate, min_child_weight / min_samples_leaf ->
minInstancesPerNode, gamma -> minInfoGain).  Options without a Spark
counterpart (min_samples_split, bootstrap, colsample_bytree, reg_alpha,
reg_lambda, num_leaves, min_child_samples) are listed in ``NO_SPARK_TWIN``.
Class weighting (balanced or none) is the choice of a weight column.
"""

FOREST_GRID = {
    "numTrees": [100, 200, 300],
    "maxDepth": [10, 20, 30],
    "minInstancesPerNode": [1, 2, 4],
    "featureSubsetStrategy": ["sqrt", "log2"],
    "weightCol": ["balanced", "even"],
}
FOREST_FOLDS = 5

BOOSTED_GRID = {
    "maxIter": [200, 300],
    "maxDepth": [5, 7, 10],
    "stepSize": [0.05, 0.1],
    "subsamplingRate": [0.8, 0.9],
    "minInstancesPerNode": [1, 3],
    "minInfoGain": [0.0, 0.1],
}
BOOSTED_FOLDS = 3

NO_SPARK_TWIN = ["min_samples_split", "bootstrap", "colsample_bytree", "reg_alpha", "reg_lambda",
                 "num_leaves", "min_child_samples"]

# Ours: small grids for the registered queries and tests (2 x 2 combinations), with balanced weights.
SMALL_FOREST_GRID = {"numTrees": [20, 50], "maxDepth": [5, 10]}
SMALL_BOOSTED_GRID = {"maxIter": [10, 20], "maxDepth": [3, 5]}

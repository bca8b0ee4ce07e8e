"""cohort_engine: cohort preparation, feature screening, model selection and
evaluation as Spark DataFrame operators.

Subpackages
-----------
sources     reading tables, fixture cohorts, schema validation, result sinks
functions   shared column-level primitives (hash order, running sums, quantiles)
operators   DataFrame -> DataFrame operators: columns, statistics, preprocessing,
            outlier screening, feature selection, metrics, interpretation
plans       estimators, fold assignment, grid and nested cross-validation,
            end-to-end train / independent-set evaluation
streaming   applying a fitted cohort model to a stream of samples
"""

__version__ = "0.1.0"

"""DataFrame -> DataFrame operators, grouped by pipeline stage.

features   activity-log aggregation (the 42 base features)
label      churn label, rule score, label summaries
engineer   derived features
quantiles  exact distributed quantiles
clean      null profile, imputation, clipping
select     feature selection / alignment, member filter
split      stratified split, folds, class weights, scaling
models     Spark ML fits, cross-validation, importances
evaluate   metrics, ROC AUC, confusion matrix, report, best model
scoring    scoring, ranking and serving queries
timeline   daily activity timelines
reports    dashboard projections
"""

"""Model use (SVM, LDA, cross-validation), the study experiments and the
query catalog with its DuckDB oracle strings."""

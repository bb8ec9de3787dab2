"""User-facing estimators: forecasting, tabular and mixed-input learning."""

"""Game-log sessions, account features and churn models on Spark."""

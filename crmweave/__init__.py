"""CRM analytics and reconciliation as plain functions over Spark DataFrames."""
